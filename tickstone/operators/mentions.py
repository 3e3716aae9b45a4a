"""Which posts contain which of many keywords, by an index over each keyword's rarest gram.

Grams are runs of 1, 2, 4 or 8 characters; a keyword's are of the greatest of these lengths that it has, so a short keyword
changes nothing for the long ones.  The posts that hold a gram of any keyword are counted per gram, and each keyword is
filed under the gram of its own that the fewest posts have; keywords with a gram that no post has are left out.  Posts meet
the index on these grams, and the pairs that meet are tested in full.

Grams are compared by hash.  A hash in common by chance makes a candidate that fails the test, nothing else.  Tasks look their
grams up in a Bloom filter sized by the number of wanted grams, so only grams of keywords leave a task.  Posts
with the same texts share their candidates.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickstone.functions.batches import text_batches
from tickstone.functions.bloom import Bloom, mixed
from tickstone.operators.lineage import settled

LENGTHS = (1, 2, 4, 8)
SLICE = 1 << 18  # bytes of text looked at together, so that their hashes stay in the processor's cache

_STEP = np.full(1, 0x9E3779B97F4A7C15, dtype=np.uint64)  # an array, whose products wrap without a warning
_GAP = "\0"  # between texts; a gram across a gap is a candidate that fails the test


def gram_hashes(codes: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of ``length`` characters, a power of two; the one at ``i`` starts there."""
    out, step, size = codes + np.uint64(length << 32), _STEP, 1
    while size < length:  # two runs side by side make one of twice the length
        out = out[:-size] * step + out[size:] if out.size > size else out[:0]
        step, size = step * step, 2 * size
    return mixed(out)


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Character codes of the texts with gaps between them, and where each text starts."""
    codes = np.frombuffer(_GAP.join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    starts = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
    return codes, starts


def _distinct(hashes: np.ndarray, at: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different (row, hash) pairs of the hashes ``at`` places; a pair is sorted as one number, row and rank of the hash."""
    grams, rank = np.unique(hashes[at], return_inverse=True)
    rows = np.searchsorted(starts, at, side="right") - 1
    rows, rank = np.divmod(np.unique(rows * max(1, grams.size) + rank), max(1, grams.size))
    return rows, grams[rank]


def _short_grams(codes: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The different (row, hash) pairs of runs of one or two characters, which nearly all repeat: made distinct before they are hashed."""
    n = max(0, codes.size - length + 1)
    rows = np.repeat(np.arange(starts.size, dtype=np.uint64), np.diff(np.append(starts, codes.size)))
    pairs = rows[:n] << np.uint64(42)
    for i in range(length):  # 21 bits a character
        pairs |= codes[i : n + i] << np.uint64(21 * (1 - i))
    pairs = np.unique(pairs)
    low = np.uint64((1 << 21) - 1)
    runs = np.stack([(pairs >> np.uint64(21 * (1 - i))) & low for i in range(length)], axis=1).ravel()
    return (pairs >> np.uint64(42)).astype(np.int64), gram_hashes(runs, length)[::length]


def _length(word: Column) -> Column:
    size = F.length(word)
    return F.lit(LENGTHS[0]) if len(LENGTHS) == 1 else F.greatest(*[F.when(size >= n, n).otherwise(LENGTHS[0]) for n in LENGTHS])


def _keyword_grams(words: DataFrame, keyword: str) -> DataFrame:
    """(keyword, length, gram), each gram once per keyword."""

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, found = [], [np.empty(0, dtype=np.uint64)]
            for i, (word, length) in enumerate(zip(batch["_lower"].to_pylist(), batch["length"].to_pylist(), strict=True)):
                found.append(np.unique(gram_hashes(_codes([word])[0], length)))
                at += [i] * found[-1].size
            rows = batch.select([keyword, "length"]).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(np.concatenate(found).view(np.int64))], [keyword, "length", "gram"])

    rows = words.select(keyword, _length(F.col("_lower")).alias("length"), "_lower")
    return rows.mapInArrow(grams, f"`{keyword}` string, length int, gram bigint")


def _hits(texts: DataFrame, wanted: Bloom, lengths: Sequence[int]) -> DataFrame:
    """(text, gram): the wanted grams of each (_text, _all), once per row."""

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "_all", SLICE):
            codes, starts = _codes(batch["_all"].to_pylist())
            names = batch["_text"].to_numpy()
            for length in lengths:
                if length <= 2:
                    rows, grams = _short_grams(codes, starts, length)
                    at = wanted.has(grams)
                    yield pa.RecordBatch.from_arrays([pa.array(names[rows[at]]), pa.array(grams[at].view(np.int64))], ["text", "gram"])
                    continue
                hashes = gram_hashes(codes, length)
                rows, grams = _distinct(hashes, np.flatnonzero(wanted.has(hashes)), starts)
                yield pa.RecordBatch.from_arrays([pa.array(names[rows]), pa.array(grams.view(np.int64))], ["text", "gram"])

    return texts.mapInArrow(hits, "text bigint, gram bigint")


def mention_join(
    posts: DataFrame,
    keywords: DataFrame,
    keyword: str = "ticker",
    texts: Sequence[str] = ("title", "content"),
) -> DataFrame:
    """Every (post, keyword) pair where the keyword occurs in one of the texts, ignoring case.

    A keyword counts once however often it is listed, an empty or NULL one not at all; a NULL text is empty.  Rows of
    ``posts`` are found one by one, whatever their other columns hold.
    """
    words = keywords.select(F.col(keyword).cast("string").alias(keyword)).where(F.length(keyword) > 0).distinct()
    grams = settled(_keyword_grams(words.withColumn("_lower", F.lower(keyword)), keyword))
    sizes = dict(tuple(r) for r in grams.groupBy("length").count().collect())  # at most four
    lengths = sorted(sizes)
    lowered = [F.lower(F.coalesce(F.col(t), F.lit(""))) for t in texts]
    # lower-cased before the join, once a post: the test after it reads them for every candidate
    named = posts.withColumns({"_text": F.xxhash64(*lowered), **{f"_lowered{i}": text for i, text in enumerate(lowered)}})
    read = named.select("_text", F.concat_ws(_GAP, *lowered).alias("_all"))
    if not lengths:
        return posts.withColumn(keyword, F.lit(None).cast("string")).limit(0)
    held = _hits(read, Bloom.of(grams, "gram", sum(sizes.values())), lengths)
    counts = held.groupBy("gram").agg(F.count("*").alias("n"))
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("g")
    index = grams.join(counts, "gram", "left").groupBy(keyword).agg(rarest)
    index = settled(index.where("g.n > 0").select(keyword, F.col("g.gram").alias("gram")))
    found = _hits(read, Bloom.of(index, "gram"), lengths)
    candidates = found.join(index, "gram").select(F.col("text").alias("_text"), keyword).distinct()
    hit = reduce(Column.__or__, [F.contains(f"_lowered{i}", F.lower(keyword)) for i in range(len(lowered))])
    return named.join(candidates, "_text").where(hit).drop("_text", *[f"_lowered{i}" for i in range(len(lowered))])
