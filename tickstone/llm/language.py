"""Language identification by rank-order profiles.

The most frequent letter n-grams (1 to 3 letters, words padded by a blank) of each language are its profile.
A document is compared by its own most frequent n-grams: each is out of place by the difference of the two
ranks, or by the full profile length if the language lacks it; the language with the smallest sum wins.

Profiles count all training texts whole: a task counts its texts, and sums per n-gram are shuffled.  What is
sent to the tasks is ``languages x PROFILE`` ranks, however large the input.

Ties between n-grams go to the smaller code, ties between languages to the smaller name.  A text that is NULL or
has no letter is ``und`` with score 0, as is any text if nothing could be learned.  The score is 1 minus the mean
displacement as a share of the largest one.  Repeated rows are classified alike; NULL languages teach nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PROFILE = 400
SHIFT = 21  # bits of a character
HELD = 500_000  # n-grams a task sums before it hands them on


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def grams(text: str) -> np.ndarray:
    """Codes of all n-grams of a text, with repeats.  Unpaired surrogates count as no letter."""
    chars = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    chars = np.where(_letters()[chars], chars, 32).astype(np.int64)
    chars = np.concatenate(([32], chars, [32]))
    chars = chars[np.concatenate(([True], (chars[1:] != 32) | (chars[:-1] != 32)))]
    if chars.size < 3:
        return chars[:0]
    two = (chars[:-1] << SHIFT) | chars[1:]
    three = ((two[:-1] << SHIFT) | chars[2:])[chars[1:-1] != 32]
    return np.concatenate((chars[chars != 32], two, three))


def ranked(codes: np.ndarray, top: int) -> np.ndarray:
    """The most frequent codes, most frequent first."""
    values, counts = np.unique(codes, return_counts=True)
    if values.size > top:  # all with at least the count of the last one, then the order among them
        least = np.partition(counts, values.size - top)[values.size - top]
        values, counts = values[counts >= least], counts[counts >= least]
    return values[np.lexsort((values, -counts))][:top]


def profiles(docs: DataFrame, text: str = "text", lang: str = "lang", top: int = PROFILE) -> DataFrame:
    """(lang, gram, rank) of the rows with a language, rank from 0."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list] = {}
        size = 0

        def summed(parts: list) -> tuple[np.ndarray, np.ndarray]:
            codes, at = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
            sums = np.bincount(at, np.concatenate([n for _, n in parts]), codes.size)
            return codes, sums.astype(np.int64)

        def out() -> Iterator[pd.DataFrame]:
            for key, parts in held.items():
                codes, sums = summed(parts)
                yield pd.DataFrame({"lang": key, "gram": codes, "n": sums})
            held.clear()

        for batch in batches:
            for key, rows in batch.groupby("lang", sort=False):
                for value in rows["text"]:
                    codes, counts = np.unique(grams(value), return_counts=True)
                    held.setdefault(key, []).append((codes, counts))
                    size += codes.size
                    if size > HELD:
                        for k in held:
                            held[k] = [summed(held[k])]
                        size = sum(p[0][0].size for p in held.values())
                        if size > HELD // 2:
                            yield from out()
                            size = 0
        yield from out()

    learn = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    learn = learn.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    counts = learn.mapInPandas(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return counts.withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < top).select("lang", "gram", "rank")


class Profiles:
    """Ranks as a matrix: a row for each known n-gram, a column for each language."""

    def __init__(self, rows: list, top: int):
        self.top = top
        self.names = sorted({r["lang"] for r in rows})
        self.codes = np.array(sorted({r["gram"] for r in rows}), dtype=np.int64)
        self.ranks = np.full((self.codes.size + 1, len(self.names)), -1, dtype=np.int64)
        column = {name: i for i, name in enumerate(self.names)}
        at = np.searchsorted(self.codes, np.array([r["gram"] for r in rows], dtype=np.int64))
        for i, r in zip(at, rows, strict=True):
            self.ranks[i, column[r["lang"]]] = r["rank"]

    def classify(self, text: str | None) -> tuple[str, float]:
        own = ranked(grams(text), self.top) if text else np.empty(0, np.int64)
        if not own.size or not self.names:
            return "und", 0.0
        at = np.minimum(np.searchsorted(self.codes, own), self.codes.size - 1)
        at[self.codes[at] != own] = self.codes.size
        theirs = self.ranks[at]
        apart = np.where(theirs < 0, self.top, np.abs(theirs - np.arange(own.size)[:, None])).sum(axis=0)
        best = int(apart.argmin())
        return self.names[best], 1.0 - float(apart[best]) / (self.top * own.size)


def predicted(known: Profiles, text: Column) -> Column:
    """Struct of lang_pred and score."""

    @F.pandas_udf("lang_pred string, score double")
    def classified(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in series:
            found = [known.classify(t) for t in texts]
            names = pd.Series([n for n, _ in found], dtype=object)
            yield pd.DataFrame({"lang_pred": names, "score": pd.Series([s for _, s in found], dtype="float64")})

    return classified(text)


def identify(docs: DataFrame, train: DataFrame, text: str = "text", lang: str = "lang", top: int = PROFILE) -> DataFrame:
    """``docs`` with lang_pred and score, learned from ``train``."""
    known = Profiles(profiles(train, text, lang, top).collect(), top)  # languages x top rows
    out = docs.withColumn("_guess", predicted(known, F.col(text)))
    return out.withColumn("lang_pred", F.col("_guess.lang_pred")).withColumn("score", F.col("_guess.score")).drop("_guess")
