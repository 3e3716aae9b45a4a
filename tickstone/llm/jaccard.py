"""Documents whose sets of word shingles are alike, by a join of parity sketches.

A set's sketch has ``blocks`` words of 64 bits.  Each shingle XORs its own 64-bit hash into one block, chosen by the
shingle.  The sketches of two sets then differ in at most as many blocks as the sets differ in shingles, so the
Hamming distance of sketches, counted in blocks, is a lower bound of the symmetric difference.

Sets of similarity t and sizes up to U differ in at most ``D = U * 2 (1 - t) / (1 + t)`` shingles.  With more than D
blocks, one block at least is equal in both sketches (pigeonhole).  Size bands grow by half; a set takes part in its
own band and, if a similar set may be in the next band, in that one as well.  Each band has its own number of blocks.

An empty block says nothing: unrelated sets have many.  A band has ``spare`` blocks more than D + 1, and a set with at
most ``spare`` empty blocks leaves them out; two such sets that are similar still share a filled block.  A set with
more empty blocks keeps all of them.

Similar sets share ``spare + 1`` blocks of a band, less the empty ones left out.  So a set leaves its most common
blocks out as well, one fewer than it must share: of the blocks two similar sets share, the rarest is put forward by
both.  A set that shares fewer blocks than it must drops out.  Groups are made of what is left.

From the rows of shared blocks, links are found without listing all pairs of a group:

1. In each block's group every set is compared with the group's best connected set.
2. The links found make components.  Groups that still hold several components probe: in a random order, each set is
   compared with the next ``PROBES`` of other components.
3. In groups that hold several components after that, sets of different components are joined.

A second sketch of ``BITS`` parity bits goes with every set.  Pairs whose bits differ in more places than
similar sets of their sizes can differ in shingles are dropped before sets are read, in steps 2 and 3 inside the window or
join, before they become rows.  These bits cannot tell sets of more than about ``2 BITS`` shingles apart.  Sets of more
than ``BITS`` shingles have a third sketch, of at least as many parity bits as shingles, which goes with distinct pairs only;
what is left is almost only links.

Comparison is exact on the shingles' 64-bit numbers.  Documents with equal sets are one node throughout.
A text that is NULL, empty or has no words has an empty set and links with nothing.  A document whose id is NULL takes
part; components are named by the smallest id that is not NULL.  Repeated rows stay repeated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickstone.llm.common import collected, may_match, text_batches, written
from tickstone.llm.graph import components
from tickstone.llm.shingles import mixed, set_number, shingles

GROWTH = 1.5  # of band sizes
PROBES = 3
BITS = 512  # of the second sketch, a power of two


def _bands(percent: int, largest: int = 1 << 40) -> list[tuple[int, int, int]]:
    """(largest set size, blocks, spare blocks) of each band."""
    out, top = [], 1
    while top < largest:
        apart = (2 * top * (100 - percent)) // (100 + percent)
        spare = -(-(apart + 1) * 3 // 20) if apart else 0
        out.append((top, apart + 1 + spare, spare))
        top = max(top + 1, int(top * GROWTH))
    return out


def _keys(values: np.ndarray, band: int, blocks: int, spare: int) -> tuple[np.ndarray, int]:
    """Keys of the blocks a set puts forward, and how many of them a similar set must share at least."""
    at = (mixed(values, 1) % np.uint64(blocks)).astype(np.int64)
    order = np.argsort(at, kind="stable")
    at, hashes = at[order], mixed(values, 2)[order]
    filled = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    xors = np.bitwise_xor.reduceat(hashes, filled)
    numbers = at[filled].astype(np.uint64)
    empty = blocks - numbers.size
    if empty > spare:
        rest = np.setdiff1d(np.arange(blocks, dtype=np.uint64), numbers)
        numbers, xors = np.concatenate((numbers, rest)), np.concatenate((xors, np.zeros(rest.size, np.uint64)))
        empty = spare
    return mixed(xors ^ mixed(numbers, 1000 + band), 3), spare + 1 - empty


_BIT_COLUMNS = [f"w{i}" for i in range(BITS // 64)]


def _parity(values: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The parity bits of a set, as signed 64-bit words.  Both halves of twice as many bits, XORed, are these bits."""
    at = (mixed(values, 5) % np.uint64(bits)).astype(np.int64)
    odd = (np.bincount(at, minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64)


def _fine(values: np.ndarray) -> np.ndarray | None:
    """The parity bits of a large set: the power of two from its size on."""
    return _parity(values, 1 << (values.size - 1).bit_length()) if values.size > BITS else None


def _slim(docs: DataFrame, id_column: str, text: str, k: int) -> DataFrame:
    """(doc_id, th, sid, n_shingles, fine, parity bits): ``th`` is xxhash64 of the text, ``sid`` numbers the set."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "text"):
            sets = [np.unique(v) for v in shingles(batch.column(1), k)]
            bits = np.stack([_parity(v) for v in sets]) if sets else np.empty((0, BITS // 64), np.int64)
            columns = [
                batch.column(0),
                batch.column(2),
                pa.array([set_number(v) for v in sets], pa.int64()),
                pa.array([v.size for v in sets], pa.int64()),
                pa.array([_fine(v) for v in sets], pa.list_(pa.int64())),
                *(pa.array(bits[:, i].copy()) for i in range(BITS // 64)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "th", "sid", "n_shingles", "fine", *_BIT_COLUMNS])

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("th"))
    kind = "doc_id long, th long, sid long, n_shingles long, fine array<long>, " + ", ".join(f"{w} long" for w in _BIT_COLUMNS)
    return rows.mapInArrow(sketch, kind)


def _blocks(docs: DataFrame, text: str, k: int, percent: int) -> DataFrame:
    """(key, sid, band, share): the blocks each set puts forward, and how many of a band a similar one must share."""
    bands = _bands(percent)
    tops = [top for top, _, _ in bands]

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "text"):
            keys, sids = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
            of, shares = [np.empty(0, np.int32)], [np.empty(0, np.int32)]
            for values in shingles(batch.column(0), k):
                values = np.unique(values)
                if not values.size:
                    continue
                band, sid = int(np.searchsorted(tops, values.size)), set_number(values)
                for b in (band, band + 1):
                    # the smallest set of the next band, and the smallest that can be similar to it
                    if b == band or 100 * values.size >= percent * (tops[band] + 1):
                        found, share = _keys(values, b, *bands[b][1:])
                        keys.append(found)
                        sids.append(np.full(found.size, sid))
                        of.append(np.full(found.size, b, dtype=np.int32))
                        shares.append(np.full(found.size, share, dtype=np.int32))
            columns = [pa.array(np.concatenate(keys).view(np.int64)), *(pa.array(np.concatenate(x)) for x in (sids, of, shares))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "sid", "band", "share"])

    return docs.select(F.col(text).alias("text")).mapInArrow(sketch, "key long, sid long, band int, share int")


def _of_several(rows: DataFrame, column: str = "sid") -> DataFrame:
    """The rows of groups with several values of ``column``."""
    group = Window.partitionBy("key")
    rows = rows.withColumn("low", F.min(column).over(group)).withColumn("high", F.max(column).over(group))
    return rows.where("low <> high").drop("low", "high")


def _rarest(live: DataFrame) -> DataFrame:
    """(key, sid) without the most common blocks of each set and band, one fewer than a similar set must share."""
    live = live.withColumn("n", F.count("*").over(Window.partitionBy("key")))
    own = Window.partitionBy("sid", "band").orderBy(F.desc("n"), F.desc("key"))
    rare = live.withColumn("place", F.row_number().over(own)).where("place >= share")
    return _of_several(rare.select("key", "sid"))


def _sets(docs: DataFrame, id_column: str, text: str, k: int, wanted: DataFrame) -> DataFrame:
    """(sid, values) of the documents named by ``wanted`` (doc_id), and of a few more that no pair asks for."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "text"):
            sets = [np.unique(v) for v in shingles(batch.column(1), k)]
            sids = pa.array([set_number(v) for v in sets], pa.int64())
            offsets = pa.array(np.concatenate(([0], np.cumsum([v.size for v in sets]))), pa.int32())
            values = pa.array(np.concatenate([*sets, np.empty(0, np.uint64)]).view(np.int64))
            yield pa.RecordBatch.from_arrays([sids, pa.ListArray.from_arrays(offsets, values)], ["sid", "values"])

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return may_match(rows, wanted, "doc_id").mapInArrow(read, "sid long, values array<long>").where("sid <> 0")


def _alike(pairs: DataFrame, slim: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets can be similar by their fine parity bits, or are too small to have them."""
    fine = slim.where("fine is not null").dropDuplicates(["sid"]).select("sid", F.struct("n_shingles", "fine").alias("x"))
    both = pairs.join(fine.withColumnsRenamed({"sid": "a"}), "a", "left")
    both = both.join(fine.withColumnsRenamed({"sid": "b", "x": "y"}), "b", "left")
    x, y = F.col("x.fine"), F.col("y.fine")
    words, most = F.least(F.size(x), F.size(y)), F.greatest(F.size(x), F.size(y))
    xor = lambda v, w: v.bitwiseXOR(w)
    folded = lambda v: F.when(F.size(v) > words, F.zip_with(F.slice(v, 1, words), F.slice(v, words + 1, words), xor)).otherwise(v)
    apart = F.aggregate(F.zip_with(folded(x), folded(y), xor), F.lit(0), lambda n, v: n + F.bit_count(v))
    near = (100 + percent) * apart <= (100 - percent) * (F.col("x.n_shingles") + F.col("y.n_shingles"))
    return both.where(F.coalesce((most > 2 * words) | near, F.lit(True))).select("a", "b")


def _linked(pairs: DataFrame, docs: DataFrame, slim: DataFrame, one: DataFrame, id_column: str, text: str, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) of set numbers whose sets are similar; the texts of these sets are read once more.

    Sets are as large as texts and are merged at every size: broadcasting either side would not hold at another.
    """
    pairs = written(_alike(written(pairs, "pairs"), slim, percent), "alike")
    members = pairs.select(F.col("a").alias("sid")).union(pairs.select("b")).distinct()
    sets = _sets(docs, id_column, text, k, one.join(members, "sid", "left_semi"))
    left = sets.select(F.col("sid").alias("a"), F.col("values").alias("x"))
    right = sets.select(F.col("sid").alias("b"), F.col("values").alias("y"))
    both = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b")
    shared = F.size(F.array_intersect("x", "y"))
    similar = 100 * shared >= percent * (F.size("x") + F.size("y") - shared)
    return written(both.where(similar).select("a", "b").distinct(), "linked")


def _near(a: str, b: str, percent: int) -> Column:
    """Whether two sets can be similar by their sizes and parity bits."""
    apart = sum((F.bit_count(F.col(a)[w].bitwiseXOR(F.col(b)[w])) for w in _BIT_COLUMNS), F.lit(0))
    n, m = F.col(a)["n_shingles"], F.col(b)["n_shingles"]
    alike = 100 * F.least(n, m) >= percent * F.greatest(n, m)
    return alike & ((100 + percent) * apart <= (100 - percent) * (n + m))


def _held(live: DataFrame, links: DataFrame) -> DataFrame:
    """Rows of the groups that the links leave in several components, with their component."""
    known = components(links)
    rows = live.join(known, live["sid"] == known["node"], "left")
    return written(_of_several(rows.select("key", "sid", F.coalesce("component", "sid").alias("part")), "part"), "held")


def links(docs: DataFrame, id_column: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80):
    """Two tables: (doc_id, th, sid, n_shingles, ...) of the documents, and (a, b) of linked set numbers that connect all
    linked sets."""
    slim = written(_slim(docs, id_column, text, k), "sets")
    collected(docs.sparkSession)  # what came before may have shuffled as much as what follows
    filled = slim.where("n_shingles > 0")
    one = filled.groupBy("sid").agg(F.min("doc_id").alias("doc_id"))
    bits = filled.groupBy("sid").agg(*[F.first(c).alias(c) for c in ("n_shingles", *_BIT_COLUMNS)])
    compared = lambda pairs: _linked(pairs, docs, slim, one, id_column, text, k, percent)
    ordered = lambda a, b: (F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    # groups of several sets
    group = Window.partitionBy("key")
    live = written(_rarest(_of_several(_blocks(docs, text, k, percent)).distinct()), "blocks")
    # the best connected set of a group leads it
    sizes = live.groupBy("key").agg((F.count("*") - 1).alias("others"))
    ties = live.join(sizes, "key").groupBy("sid").agg(F.sum("others").alias("ties"))
    led = live.join(ties, "sid").withColumn("lead", F.max(F.struct("ties", "sid")).over(group)["sid"])
    pairs = led.where("sid <> lead").select(*ordered("sid", "lead")).distinct()
    known = bits.select("sid", F.struct("n_shingles", *_BIT_COLUMNS).alias("x"))
    pairs = pairs.join(known.select(F.col("sid").alias("a"), "x"), "a").join(known.select(F.col("sid").alias("b"), F.col("x").alias("y")), "b")
    found = compared(pairs.where(_near("x", "y", percent)).select("a", "b"))
    # probes
    held = _held(live, found)
    row = F.struct("sid", "part", "n_shingles", *_BIT_COLUMNS)
    rows = held.join(bits, "sid").select("key", row.alias("x"))
    order = Window.partitionBy("key").orderBy(F.xxhash64("key", "x.sid"))
    nexts = F.array(*[F.lead("x", i).over(order) for i in range(1, PROBES + 1)])
    probes = rows.select("x", nexts.alias("ys")).select("x", F.explode("ys").alias("y")).where(_near("x", "y", percent) & F.expr("x.part <> y.part"))
    pairs = probes.select(*ordered("x.sid", "y.sid"))
    found = written(found.union(compared(pairs.distinct())), "linked")
    # what is left
    held = _held(held.drop("part"), found)
    rows = held.join(bits, "sid").select("key", row.alias("x"))
    both = rows.join(rows.withColumnRenamed("x", "y"), "key").where(F.expr("x.sid < y.sid and x.part <> y.part") & _near("x", "y", percent))
    pairs = both.select(*ordered("x.sid", "y.sid")).distinct()
    return slim, written(found.union(compared(pairs)), "links")


def clusters(docs: DataFrame, id_column: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, th, n_shingles, part, component_id) of each row.

    ``component_id`` is the smallest id reachable by links; ``part`` numbers the component, NULL for an empty set.
    """
    slim, linked = links(docs, id_column, text, k, percent)
    known = components(linked)
    # each set with its component, named by a set number, then by the smallest document of all its sets
    one = slim.where("n_shingles > 0").groupBy("sid").agg(F.min("doc_id").alias("doc_id"))
    sets = one.join(known, F.col("sid") == F.col("node"), "left")
    sets = sets.select("sid", "doc_id", F.coalesce("component", "sid").alias("part"))
    parts = sets.groupBy("part").agg(F.min("doc_id").alias("component_id"))
    named = sets.select("sid", "part").join(parts, "part")
    out = slim.select("doc_id", "th", "n_shingles", F.expr("if(n_shingles > 0, sid, null)").alias("sid")).join(named, "sid", "left")
    return out.select("doc_id", "th", "n_shingles", "part", F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without those linked to a kept one: of each component the smallest id (NULL last) stays.

    Documents with empty sets stay.  Rows of one id and one text are one document and stay or go together.
    """
    found = written(clusters(docs, id_column, text, k, percent).where("part is not null"), "clusters")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "th")
    kept = found.groupBy("part").agg(F.min(place).alias("kept"), F.count("*").alias("n")).where("n > 1")
    gone = found.join(kept, "part").where(place != F.col("kept")).select("doc_id", "th").distinct()
    gone = gone.select(F.col("doc_id").alias("_gone_id"), F.col("th").alias("_gone_th"))
    own = F.col(id_column).cast("long").eqNullSafe(F.col("_gone_id")) & (F.xxhash64(text) == F.col("_gone_th"))
    return docs.join(gone, own & F.col(text).isNotNull(), "left_anti")
