"""Ranked lexical search: one automaton of all items' terms is run over the documents' texts.

A term is a run of ASCII letters and digits and of all characters beyond ASCII; only A-Z are lower-cased.  In a text every
other character becomes a blank, and the automaton (Aho-Corasick) holds each term between two blanks, so that it finds whole
terms only.  Its outputs are term numbers, which map to the items that have the term.  There is no index of the documents:
they are read twice, once for the counts (documents, their terms, documents per term) and once for the scores.

The automaton is sent to every task, so its terms are bounded by ``TERM_BYTES``.  Items beyond that are dealt into shards, each
with an automaton and two scans of its own.  A task keeps the ``k`` best documents per item, whatever its input; these
are cut again per item and part of the ids, then per item.

A row of ``docs`` is a document, also if its id is NULL or repeats; it is placed by score, then id, NULL last.  Rows of ``items``
with one id are one item with the terms of all its texts; a NULL id is an item as well.  NULL and empty texts have no term: such
documents count nowhere, such items have no result, nor has anything if ``docs`` or ``items`` is empty.  A text is
taken whole, as one string in its task.  Further columns are not read.  Weights are computed in doubles, all else in integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from operator import itemgetter
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickstone.llm.common import lowered, text_batches, written

TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
TERM_BYTES = 1 << 20  # of the terms of one automaton
SALTS = 32  # parts of the ids, ranked before the items
HELD = 200_000  # rows a task holds before it cuts them to the best

_BLANKS = bytes(c if c > 127 else ord(chr(c).lower()) if chr(c).isalnum() else ord(" ") for c in range(256))


def terms(text: Column) -> Column:
    return F.regexp_extract_all(lowered(text), F.lit(TERM), F.lit(0))


def guarded(text: bytes) -> str:
    """The terms of a text with one blank or more before and after each."""
    return f" {text.translate(_BLANKS).decode('utf-8', 'surrogateescape')} "


@lru_cache(maxsize=1)
def automaton(joined: str) -> ahocorasick.Automaton:
    """Finds the blank-separated terms of ``joined`` and tells their numbers; kept for the tasks of a worker."""
    out = ahocorasick.Automaton()
    for i, term in enumerate(joined.split(" ")):
        out.add_word(f" {term} ", i)
    out.make_automaton()
    return out


def found(machine: ahocorasick.Automaton, text: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    """Numbers of the terms in a text, how often each occurs, and the count of all its terms."""
    hits = np.fromiter(map(itemgetter(1), machine.iter(guarded(text))), dtype=np.int64)
    numbers, counts = np.unique(hits, return_counts=True)
    return numbers, counts.astype(np.int64), len(text.translate(_BLANKS).split())


class Shard(NamedTuple):
    """Items whose terms one automaton holds.  Term ``t`` is in ``items[at[starts[t]:starts[t + 1]]]``."""

    joined: str
    starts: np.ndarray
    at: np.ndarray
    items: pa.Array


def shards(pairs: DataFrame, term_bytes: int = TERM_BYTES) -> Iterator[Shard]:
    """Distinct (item, term) rows as shards of at most ``term_bytes``, or of one item each."""
    size = F.sum(F.octet_length("term") + 2).cast("long")
    n = 1
    while True:
        shard = F.pmod(F.xxhash64("item"), F.lit(n))
        sizes = pairs.groupBy(shard.alias("shard")).agg(size.alias("bytes"), F.countDistinct("item").alias("items"))
        largest = sizes.where("items > 1").agg(F.max("bytes")).first()[0] or 0
        if largest <= term_bytes:
            break
        n = max(2 * n, 2 * -(-largest // term_bytes))
    for i in range(n):
        rows = pairs.where(shard == i).toArrow().combine_chunks()
        if not rows.num_rows:
            continue
        items = rows["item"].combine_chunks().dictionary_encode("encode")
        words = rows["term"].combine_chunks().dictionary_encode()
        numbers = words.indices.to_numpy()
        order = np.argsort(numbers, kind="stable")
        starts = np.concatenate(([0], np.bincount(numbers).cumsum()))
        yield Shard(" ".join(words.dictionary.to_pylist()), starts, items.indices.to_numpy()[order], items.dictionary)


def counted(docs: DataFrame, shard: Shard) -> tuple[int, int, np.ndarray]:
    """Documents with a term, the sum of their terms, and how many documents hold each term of the shard."""
    joined, size = shard.joined, shard.starts.size - 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, sums = automaton(joined), np.zeros(size + 2, dtype=np.int64)
        for batch in text_batches(batches, "text"):
            for text in batch.column("text").to_pylist():
                numbers, _, n = found(machine, text)
                sums[numbers] += 1
                sums[size] += n > 0
                sums[size + 1] += n
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[some])], ["number", "n"])

    sums = docs.select("text").mapInArrow(count, "number long, n long").groupBy("number").agg(F.sum("n").alias("n")).toArrow()
    all_sums = np.zeros(size + 2, dtype=np.int64)
    all_sums[sums["number"].to_numpy()] = sums["n"].to_numpy()
    return int(all_sums[size]), int(all_sums[size + 1]), all_sums[:size]


class Best:
    """The ``k`` best documents of each item among those added."""

    def __init__(self, k: int, n_items: int):
        self.k, self.held, self.parts = k, 0, []
        self.least = np.ones(n_items, dtype=np.int64)  # scores below are not among the best

    def add(self, items: np.ndarray, scores: np.ndarray, doc: int, unnamed: bool) -> None:
        good = np.flatnonzero(scores >= self.least[items])
        row = np.empty((4, good.size), dtype=np.int64)
        row[0], row[1], row[2], row[3] = items[good], scores[good], unnamed, doc
        self.parts.append(row)
        self.held += good.size
        if self.held > HELD:
            self.cut()

    def cut(self) -> np.ndarray:
        rows = np.concatenate(self.parts, axis=1) if self.parts else np.empty((4, 0), dtype=np.int64)
        rows = rows[:, np.lexsort((rows[3], rows[2], -rows[1], rows[0]))]
        first = np.searchsorted(rows[0], rows[0])
        place = np.arange(rows.shape[1]) - first
        last = place == self.k - 1
        self.least[rows[0, last]] = rows[1, last]
        rows = rows[:, place < self.k]
        self.parts, self.held = [rows], 0
        return rows


def scored(docs: DataFrame, shard: Shard, k: int, kind: str = "long") -> DataFrame:
    """(item, doc, score): the ``k`` best documents of each item and task; ``kind`` is the type of the items' ids."""
    n_docs, n_terms, holding = counted(docs, shard)
    weights = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in holding.tolist()]
    weights = np.array(weights, dtype=np.int64)
    joined, starts, at, items = shard
    lengths = np.diff(starts)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, best = automaton(joined), Best(k, len(items))
        sums = np.zeros(len(items), dtype=np.int64)
        for batch in text_batches(batches, "text"):
            for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist(), strict=True):
                numbers, tf, n = found(machine, text)
                if not numbers.size:
                    continue
                m = 10 + 90 * n * n_docs // n_terms
                parts = weights[numbers] * (1_000_000_000 * tf // (1000 * tf + 8 * m))
                of = lengths[numbers]
                places = np.repeat(starts[numbers] - np.concatenate(([0], of.cumsum()[:-1])), of) + np.arange(of.sum())
                np.add.at(sums, at[places], np.repeat(parts, of))
                hit = np.flatnonzero(sums)
                best.add(hit, sums[hit], 0 if doc is None else doc, doc is None)
                sums[hit] = 0
        rows = best.cut()
        named = pa.array(rows[3], mask=rows[2].astype(bool))
        yield pa.RecordBatch.from_arrays([items.take(pa.array(rows[0])), named, pa.array(rows[1])], ["item", "doc", "score"])

    return docs.mapInArrow(score, f"item {kind}, doc long, score long")


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", term_bytes: int = TERM_BYTES
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` highest-scoring documents of each item, from rank 1."""
    pairs = items.where(F.col(text).isNotNull()).select(F.col(item_id).alias("item"), F.explode(terms(F.col(text))).alias("term"))
    pairs = written(pairs.distinct(), "item-terms")
    texts = docs.where(F.col(text).isNotNull()).select(F.col(doc_id).cast("long").alias("doc"), F.col(text).cast("binary").alias("text"))
    best = None
    for shard in shards(pairs, term_bytes):
        rows = scored(texts, shard, k, pairs.schema["item"].dataType.simpleString())
        best = rows if best is None else best.unionAll(rows)
    if best is None:
        best = pairs.select("item", F.lit(0).cast("long").alias("doc"), F.lit(0).cast("long").alias("score"))
    order = [F.desc("score"), F.col("doc").asc_nulls_last()]
    salt = F.pmod(F.xxhash64("doc"), F.lit(SALTS))
    best = best.withColumn("salt", salt).withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order)))
    best = best.where(F.col("rank") <= k).drop("rank", "salt")
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
    return best.select(F.col("item").alias(item_id), "rank", F.col("doc").alias(doc_id), "score")
