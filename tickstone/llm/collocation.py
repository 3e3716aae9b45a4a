"""Phrases of two and three words that stand together more often than their parts, per language.

Phrases are mined as Toivonen does.  A sample proposes phrases at a lowered count.  A full pass then counts exactly, over
whole texts, the proposed phrases and their negative border: every phrase that was not proposed though all its parts were, so
all words, pairs of proposed words and triples of proposed pairs.  A phrase of the border that turns out frequent is a failure
of the sample.  Further full passes count what such failures open up, pairs of frequent words and triples of frequent
pairs that no pass has counted, until none is found.  Three words are the longest phrase, so there are three passes at most, and
the result is that of counting everything; the sample decides only what a pass counts.

Which words and pairs are proposed or frequent goes to the tasks as Bloom filters sized by the counted rows, at most
``MOST_BITS`` each.  They have no false negative, and a false positive is counted exactly like any other phrase and dropped if it is
rare, so a filter that fills up beyond that size only lets more phrases be counted.  Tasks count slices of their texts; counts are
added up per phrase before and after the shuffle, so a frequent phrase or language sends one row per task.  The best ones
per language are cut first per language and part of the phrases.

A NULL language is ``und`` and the same group as the language of that name; a NULL or empty text has no word.  Repeated rows
count each time.  Equal scores go by count, then phrase.  An empty table gives no rows.  Columns other than the id, text and language are
not read.  A very long text is one slice, held whole in its task.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickstone.llm.common import text_batches, written

LEAST = 10  # occurrences of a frequent phrase
SHARE = 0.1  # of the documents in the sample
TOP = 2000
INSIDE = 50  # percent of a phrase's occurrences in one longer candidate that drop it
MOST_BITS = 1 << 28
SLICE = 4 << 20  # bytes of text counted at once
SALTS = 32  # parts of the phrases, ranked before the languages

_BREAK = b"."
_PLAIN = bytes.maketrans(
    string.ascii_uppercase.encode() + b",;:!?\x0a\x0b\x0c\x0d\t", string.ascii_lowercase.encode() + _BREAK * 9 + b" "
)
_COUNTS = "lang string, size int, phrase binary, n long"


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers (the finaliser of MurmurHash3)."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang) & 0xFFFFFFFF
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), dtype=np.uint64, count=len(words))


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mixed(first * np.uint64(3) + second)


class Filter:
    """A Bloom filter of 64-bit hashes with two bits each; one without bits has nothing, or all hashes."""

    def __init__(self, words: np.ndarray | None = None, everything: bool = False):
        self.words, self.everything = words, everything

    def has(self, hashes: np.ndarray) -> np.ndarray:
        if self.words is None:
            return np.full(hashes.size, self.everything)
        out = np.ones(hashes.size, dtype=bool)
        for at in self.places(hashes, self.words.size * 64):
            out &= ((self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).astype(bool)
        return out

    @staticmethod
    def places(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
        return [hashes & np.uint64(bits - 1), (hashes >> np.uint64(32)) & np.uint64(bits - 1)]

    @classmethod
    def of(cls, phrases: DataFrame) -> Filter:
        """Of (lang, phrase) rows, all words or all pairs; the filter's words, not the phrases, pass through the driver."""
        n = phrases.count()
        if not n:
            return cls()
        bits = min(MOST_BITS, 1 << max(16, (16 * n - 1).bit_length()))

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = [np.empty(0, dtype=np.uint64)]
                for lang, rows in by_language(batch):
                    parts = [p.split(b" ") for p in rows.column("phrase").to_pylist()]
                    hashes = [word_hashes(lang, [p[i] for p in parts]) for i in range(len(parts[0]))]
                    at += cls.places(pair_hashes(*hashes) if len(hashes) == 2 else hashes[0], bits)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(at).astype(np.int64))], ["at"])

        word = F.shiftright("at", 6).alias("word")
        rows = phrases.select("lang", F.col("phrase").cast("binary").alias("phrase")).mapInArrow(place, "at long").groupBy(word)
        rows = rows.agg(F.expr("bit_or(shiftleft(1L, cast(at % 64 as int)))").alias("bits")).toArrow()
        words = np.zeros(bits // 64, dtype=np.uint64)
        words[rows["word"].to_numpy()] = rows["bits"].to_numpy().astype(np.uint64)
        return cls(words)


def by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.RecordBatch]]:
    for lang in pc.unique(batch.column("lang")).to_pylist():
        yield lang, batch.filter(pc.equal(batch.column("lang"), lang))


class Opened:
    """Which pairs or triples a pass counts: both parts in ``new``, and not both in one filter of an earlier pass."""

    def __init__(self, new: Filter, earlier: list[Filter]):
        self.filters = [new, *earlier]

    def mask(self, hashes: np.ndarray) -> list[np.ndarray]:
        return [f.has(hashes) for f in self.filters]

    @staticmethod
    def both(masks: list[np.ndarray], first: np.ndarray, second: np.ndarray) -> np.ndarray:
        inside = [m[first] & m[second] for m in masks]
        return inside[0] & ~reduce(np.logical_or, inside[1:], np.zeros(inside[0].size, dtype=bool))


def slice_counts(lang: str, texts: list[bytes], words: bool, pairs: Opened, triples: Opened) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """(size, phrases, counts) of one language's texts; size 0 is the count of all words."""
    found = _BREAK.join(texts).translate(_PLAIN).replace(_BREAK, b" . ").split()
    found.append(_BREAK)
    found = pa.array(found, pa.binary()).dictionary_encode()
    codes, known = found.indices.to_numpy().astype(np.int64), found.dictionary
    n_known, stop = len(known), int(codes[-1])
    if words:
        counts = np.bincount(codes, minlength=n_known)
        counts[stop] = 0
        some = np.flatnonzero(counts)
        yield 0, pa.array([b""]), counts.sum(keepdims=True)
        yield 1, known.take(pa.array(some)), counts[some]
    hashes = word_hashes(lang, known.to_pylist())
    masks = pairs.mask(hashes)
    at = np.flatnonzero((codes[:-1] != stop) & (codes[1:] != stop))
    pair, of, n = np.unique(codes[at] * n_known + codes[at + 1], return_inverse=True, return_counts=True)
    first, second = pair // n_known, pair % n_known
    some = np.flatnonzero(pairs.both(masks, first, second))
    join = lambda *parts: pc.binary_join_element_wise(*[known.take(pa.array(p)) for p in parts], pa.scalar(b" "))
    yield 2, join(first[some], second[some]), n[some]
    masks = triples.mask(pair_hashes(hashes[first], hashes[second]))
    next_too = np.flatnonzero(at[1:] == at[:-1] + 1)
    open_too = next_too[triples.both(masks, of[next_too], of[next_too + 1])]
    triple, n = np.unique(of[open_too] * n_known + codes[at[open_too] + 2], return_counts=True)
    pair, third = triple // n_known, triple % n_known
    yield 3, join(first[pair], second[pair], third), n


def counted(docs: DataFrame, words: bool, pairs: Opened, triples: Opened, least: int) -> DataFrame:
    """One pass over (lang, text): (lang, size, phrase, n) of what it counts, with n of ``least`` or more, and the words' totals."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "text", SLICE):
            for lang, rows in by_language(batch):
                for size, phrases, n in slice_counts(lang, rows.column("text").to_pylist(), words, pairs, triples):
                    columns = [pa.array([lang] * len(n), pa.string()), pa.array(np.full(len(n), size, dtype=np.int32)), phrases, pa.array(n)]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "size", "phrase", "n"])

    rows = docs.mapInArrow(count, _COUNTS).groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))
    return rows.where((F.col("n") >= least) | (F.col("size") == 0)).withColumn("phrase", F.col("phrase").cast("string"))


def frequent(docs: DataFrame, least: int = LEAST, share: float = SHARE) -> DataFrame:
    """(lang, size, phrase, n) of all words and phrases of up to three words with ``least`` occurrences in (id, lang, text); size 0: all words."""
    everything = Opened(Filter(everything=True), [])
    mean = least * share
    sample = docs.where(F.pmod(F.xxhash64("id", "text"), F.lit(1 << 20)) < int(share * (1 << 20)))
    proposed = counted(sample.drop("id"), True, everything, everything, max(2, math.floor(mean - 2 * math.sqrt(mean))))
    proposed = written(proposed.where("size > 0").select("lang", "size", "phrase"), "proposed")
    docs = docs.drop("id")
    of_size = lambda rows, size: rows.where(F.col("size") == size).select("lang", "phrase")
    word_filters, pair_filters = [Filter.of(of_size(proposed, 1))], [Filter.of(of_size(proposed, 2))]
    out = written(counted(docs, True, Opened(word_filters[0], []), Opened(pair_filters[0], []), least), "frequent")
    failed = out.where("size in (1, 2)").join(proposed, ["lang", "size", "phrase"], "left_anti")
    while not failed.isEmpty():
        word_filters.insert(0, Filter.of(of_size(out, 1)))
        pair_filters.insert(0, Filter.of(of_size(out, 2)))
        more = counted(docs, False, Opened(word_filters[0], word_filters[1:]), Opened(pair_filters[0], pair_filters[1:]), least)
        more = written(more, "frequent")
        failed, out = more.where("size = 2"), out.unionAll(more)
    return out


def collocations(
    docs: DataFrame, doc_id: str = "doc_id", lang: str = "lang", text: str = "text", least: int = LEAST, top: int = TOP, share: float = SHARE
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    ``a`` counts the phrase, ``l`` and ``r`` the parts of its weakest cut, ``n`` all words; the score is
    a * a / (l * r) in millionths.
    """
    texts = docs.where(F.col(text).isNotNull())
    named = F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang")
    found = frequent(texts.select(F.col(doc_id).alias("id"), named, F.col(text).cast("binary").alias("text")), least, share)
    return ranked(found, top)


def ranked(found: DataFrame, top: int = TOP) -> DataFrame:
    """The result of :func:`collocations` from the counts of :func:`frequent`."""
    candidates = found.where("size >= 2")
    cut = F.col("cut")
    words = F.split("phrase", " ")
    part = lambda start, length: F.concat_ws(" ", F.slice(words, start, length))
    cuts = candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumn("left", part(F.lit(1), cut)).withColumn("right", part(cut + 1, F.col("size") - cut))
    part_counts = found.where("size between 1 and 2")
    cuts = cuts.join(part_counts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
    cuts = cuts.join(part_counts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    exact = "cast(n as decimal(19, 0)) * cast(n as decimal(19, 0)) * 1000000 div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))"
    weakest = F.min(F.struct(F.expr(exact).alias("score"), "cut", "l", "r")).alias("w")
    out = cuts.groupBy("lang", "size", "phrase", F.col("n").alias("a")).agg(weakest)
    inner = F.explode(F.array(part(F.lit(1), F.lit(2)), part(F.lit(2), F.lit(2)))).alias("phrase")
    longer = candidates.where("size = 3").select("lang", inner, "n").groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    out = out.join(longer, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("longer") < INSIDE * F.col("a"), F.lit(True)))
    out = out.select("lang", "phrase", "a", "w.l", "w.r", "w.score").withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    out = out.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    out = out.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    totals = found.where("size = 0").select("lang", F.col("n").alias("n"))
    out = out.join(totals, "lang").withColumn("rank", F.col("rank").cast("long"))
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
