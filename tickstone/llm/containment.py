"""Benchmark items contained in documents, by MinHash in size partitions.

Items are partitioned by their number of distinct shingles, repeats not counted: partition p holds those of up to
``2**p``.  For it, a document is cut into half-overlapping windows of two runs of ``2**p`` shingles, so that an item
that occurs in the text and does not repeat itself lies whole in one window.  Each of ``HASHES`` MinHash functions gives
the smallest number of a window; windows of a larger partition take the minima of two smaller ones, so all partitions
cost little more than the smallest.  An item that fills at least a quarter of a window shares a minimum
with it with probability above 1 - 0.81**48, for a containment of 0.8.  If its shingles stand in several windows (it
repeats itself, or is dealt over the text), each that the document has is in a window with less than four times as many
others as the item has shingles, and the probability that one of these windows shares a minimum is above 1 - 0.84**48.

A window's minima are looked up in a bitmap of fixed size that holds the items' minima; those found are joined with the
items' minima on exact values, which gives candidate pairs.  Which shingles a document shares with items is told by a
second such bitmap and joined as text: containment is counted exactly on the words of both.

Containment is the share of an item's distinct shingles of ``k`` words that the whole document has.  Items with fewer
than ``k`` words have no shingle and are found nowhere; NULL and empty texts contain nothing.  Rows of one id and one text
are one document.  Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickstone.llm.common import text_batches, written
from tickstone.llm.shingles import combined, mixed, shingles, text_bytes, words

HASHES = 48
BITS = 1 << 24  # of each bitmap: 2 MB
PROBES = 3


def _slots(keys: np.ndarray, probe: int) -> np.ndarray:
    return (mixed(keys, 50 + probe) % np.uint64(BITS)).astype(np.int64)


def _found(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Indices of the keys that the bitmap may hold."""
    at = np.arange(keys.size)
    for probe in range(PROBES):
        slot = _slots(keys[at], probe)
        at = at[(bitmap[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1]
    return at


def _bitmap(keys: DataFrame) -> np.ndarray:
    """Bitmap of a column ``key``; the work is Spark's, the driver gets words of the fixed-size map."""

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            at = np.unique(np.concatenate([_slots(own, p) for p in range(PROBES)]))
            yield pa.RecordBatch.from_arrays([pa.array(at)], ["slot"])

    found = keys.select("key").mapInArrow(slots, "slot long").groupBy(F.shiftright("slot", 5).alias("word"))
    found = found.agg(F.expr("bit_or(shiftleft(1L, cast(slot % 32 as int)))").alias("bits"))
    out = np.zeros(BITS // 32, dtype=np.uint32)
    rows = found.toArrow()
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy().astype(np.uint32)
    return out.view(np.uint8)


_FACTORS = mixed(np.arange(1, HASHES + 1, dtype=np.uint64), 11) | np.uint64(1)


def _run_minima(values: np.ndarray, run: int) -> np.ndarray:
    """Smallest number of each run under each hash function, a row for each function."""
    starts = np.arange(0, values.size, run)
    return np.stack([np.minimum.reduceat(values * factor, starts) for factor in _FACTORS])


def _level(size: int) -> int:
    return max(0, int(size - 1).bit_length())


def _window_keys(level: int, minima: np.ndarray) -> np.ndarray:
    salt = np.arange(HASHES, dtype=np.uint64)[:, None] * np.uint64(64) + np.uint64(level)
    return mixed(minima ^ mixed(salt, 7), 8)


def _item_keys(items: DataFrame, item_id: str, text: str, k: int) -> DataFrame:
    """(item_id, level, key) with the minima of each item."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "text"):
            for i, values in enumerate(shingles(batch.column(1), k, short=False)):
                if values.size:
                    level = _level(np.unique(values).size)
                    found = _window_keys(level, _run_minima(values, values.size)).ravel().view(np.int64)
                    ids = pa.array([batch.column(0)[i].as_py()] * found.size, batch.column(0).type)
                    yield pa.RecordBatch.from_arrays([ids, pa.array([level] * found.size, pa.int32()), pa.array(found)], ["item_id", "level", "key"])

    rows = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text"))
    return rows.mapInArrow(keys, "item_id long, level int, key long")


def _shingle_texts(data: memoryview, first: np.ndarray, last: np.ndarray, at: np.ndarray, k: int) -> list[str]:
    """The ``k`` words from each place on, A-Z lower-cased, as text."""
    low = lambda i: bytes(data[first[i] : last[i]]).lower()
    return [b" ".join(low(i) for i in range(j, j + k)).decode("utf-8", "replace") for j in at]


def _distinct_texts(column: pa.Array, k: int) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Numbers and texts of each text's distinct shingles."""
    values, starts, first, last = words(column)
    joined, data = combined(values, k), memoryview(text_bytes(column)[0])
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        numbers, once = np.unique(joined[a : max(a, b - k + 1)], return_index=True)
        yield numbers, _shingle_texts(data, first, last, a + once, k)


def contained(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    k: int = 5,
    percent: int = 80,
) -> DataFrame:
    """(doc_id, text_hash, item_id, n_item, n_shared, containment) of all pairs with at least ``percent`` containment."""
    item_keys = written(_item_keys(items, item_id, item_text, k), "items")
    levels = sorted(r["level"] for r in item_keys.select("level").distinct().collect())  # at most 40 size partitions

    def all_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "text"):
            ids, texts, numbers = [], [], []
            for i, (own_numbers, found) in enumerate(_distinct_texts(batch.column(1), k)):
                ids += [batch.column(0)[i].as_py()] * len(found)
                texts += found
                numbers.append(own_numbers.view(np.int64))
            numbers = pa.array(np.concatenate([*numbers, np.empty(0, np.int64)]))
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.column(0).type), pa.array(texts, pa.string()), numbers], ["item_id", "shingle", "key"])

    own = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text"))
    own = written(own.mapInArrow(all_texts, "item_id long, shingle string, key long"), "item-shingles")
    minima_map, shingle_map = _bitmap(item_keys), _bitmap(own)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "text", 1 << 20):
            values, starts, first, last = words(batch.column(1))
            joined, data = combined(values, k), memoryview(text_bytes(batch.column(1))[0])
            # the shingles of each text, one after the other
            ends = np.maximum(starts[:-1], starts[1:] - k + 1)
            inside = np.zeros(joined.size + 1, dtype=np.int64)
            np.add.at(inside, np.minimum(starts[:-1], joined.size), 1)
            np.add.at(inside, np.minimum(ends, joined.size), -1)
            places = np.flatnonzero(np.cumsum(inside)[:-1])
            own = joined[places]
            edges = np.concatenate(([0], np.cumsum(ends - starts[:-1])))
            hits: dict[int, set] = {}
            for a, b, key in _matches(own, levels, minima_map):
                last_row = min(int(np.searchsorted(edges, b, "left")), batch.num_rows)
                for i in range(int(np.searchsorted(edges, a, "right")) - 1, last_row):
                    hits.setdefault(i, set()).add(key)
            ids, hashes, keys, texts = [], [], [], []
            for i in sorted(hits):
                found = own[edges[i] : edges[i + 1]]
                at = _found(shingle_map, found)
                _, once = np.unique(found[at], return_index=True)
                shared = _shingle_texts(data, first, last, places[edges[i] + at[once]], k)
                n = len(hits[i]) + len(shared)
                ids += [batch.column(0)[i].as_py()] * n
                hashes += [batch.column(2)[i].as_py()] * n
                keys += [*hits[i], *[None] * len(shared)]
                texts += [*[None] * len(hits[i]), *shared]
            columns = [pa.array(ids, pa.int64()), pa.array(hashes, pa.int64()), pa.array(keys, pa.int64()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "key", "shingle"])

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))
    found = written(rows.mapInArrow(scan, "doc_id long, text_hash long, key long, shingle string"), "found")
    candidates = found.where("key is not null").join(item_keys.select("item_id", "key"), "key")
    candidates = candidates.select("doc_id", "text_hash", "item_id").distinct()
    texts = own.select("item_id", "shingle").distinct()
    shared = found.where("shingle is not null").select("doc_id", "text_hash", "shingle").distinct().join(texts, "shingle")
    shared = shared.groupBy("doc_id", "text_hash", "item_id").agg(F.count("*").alias("n_shared"))
    sizes = texts.groupBy("item_id").agg(F.count("*").alias("n_item"))
    both = shared.alias("s").join(
        candidates.alias("c"),
        F.expr("s.doc_id <=> c.doc_id and s.text_hash = c.text_hash and s.item_id <=> c.item_id"),
        "left_semi",
    )
    both = both.join(sizes.withColumnRenamed("item_id", "i"), F.expr("item_id <=> i")).where(100 * F.col("n_shared") >= percent * F.col("n_item"))
    return both.select("doc_id", "text_hash", "item_id", "n_item", "n_shared", (F.col("n_shared") / F.col("n_item")).alias("containment"))


def _matches(values: np.ndarray, levels: list[int], bitmap: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(first, end, key) of the windows of a row of shingles that have a minimum of an item.

    The row may hold several texts: a window over an end only adds a candidate that the exact test turns down.
    """
    step = 1 << 14  # a part and what the windows that begin in it reach
    for part in range(0, values.size if levels else 0, step):
        own = values[part : part + step + (2 << levels[-1])]
        runs = _run_minima(own, 1 << levels[0])
        for level in range(levels[0], levels[-1] + 1):
            if level > levels[0]:  # two runs of the level before make one of this
                if runs.shape[1] % 2:
                    runs = np.concatenate((runs, runs[:, -1:]), axis=1)
                runs = np.minimum(runs[:, ::2], runs[:, 1::2])
            if level in levels:
                windows = np.minimum(runs[:, :-1], runs[:, 1:]) if runs.shape[1] > 1 else runs
                keys = _window_keys(level, windows).ravel()
                at = _found(bitmap, keys)
                first = part + ((at % windows.shape[1]) << level)
                yield from zip(first.tolist(), (first + (2 << level)).tolist(), keys[at].view(np.int64).tolist(), strict=True)


def decontaminate(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that contain no item."""
    bad = contained(docs, items, id_column, text, **options).select("doc_id", "text_hash").distinct()
    bad = bad.select(F.col("doc_id").alias("_bad_id"), F.col("text_hash").alias("_bad_hash"))
    own = F.col(id_column).cast("long").eqNullSafe(F.col("_bad_id")) & (F.xxhash64(text) == F.col("_bad_hash"))
    return docs.join(bad, own, "left_anti")
