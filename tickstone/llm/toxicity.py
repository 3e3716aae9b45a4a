"""Toxic passages as maximum-scoring segments of token log-odds.

1. Token log-odds of toxic against clean labelled texts, with an informative Dirichlet prior proportional to the
   tokens' overall frequency.  Beginnings of 4 to 7 letters count as tokens too, so that inflected and compound words
   are known by their stem.  A text counts a token once.  Tokens whose log-odds are at least ``least_z`` standard
   errors from 0 keep them, less one standard error.  A word has the value of the surest token that it is or
   begins with; a word without one costs ``drift``.
2. One linear scan finds all maximal scoring segments of a text.
3. Segment scores follow an extreme-value law on clean texts: the expected number of segments that score S in n
   tokens is ``K n exp(-lambda S)``.  lambda solves the moment equation of the clean token scores, K is its maximum
   likelihood estimate over the best segments of all clean training texts.
4. A text's evidence is the sum of -ln(expected number) over its significant segments; a logistic curve fitted on
   the training texts turns it into a probability.

Everything is counted over all labelled rows and stays distributed, but for the table of significant tokens: all of them
are kept, none is cut, and the driver and each worker hold the table.  NULL and empty texts have no segment and get
the curve's value at no evidence.  Without labelled rows of both kinds nothing can be learned and every score is 0.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickstone.llm.common import written

_TOKEN = re.compile(r"[^\W\d_]+")
STEMS = (4, 5, 6, 7)
KNOWN = 50_000  # words whose value a worker remembers before it starts again; a corpus has many that come once
HELD = 100_000  # tokens a task counts before it hands them on
BINS_A_UNIT, MOST = 4, 100.0  # evidence is binned for the curve: quarter units up to 100


def tokens(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


def features(word: str) -> list[str]:
    """The word and its beginnings, marked by a star."""
    return [word, *(f"{word[:n]}*" for n in STEMS if n < len(word))]


def maximal_segments(scores: list[tuple[int, int, float]]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments of (first, last, score) items, in order, in linear time."""
    found: list[tuple[int, int, float, float, int]] = []  # first, last, sum before, sum after, last one that starts lower
    total = 0.0
    for first, last, score in scores:
        before, total = total, total + score
        if score <= 0:
            continue
        start = first
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= before:
                j = found[j][4]
            if j < 0 or found[j][3] >= total:
                found.append((start, last, before, total, j))
                break
            start, before = found[j][0], found[j][2]
            del found[j:]
    return [(a, b, after - before) for a, b, before, after, _ in found]


class Values(dict):
    """Value of a word, None without one; looked up once and remembered."""

    def __init__(self, weights: dict[str, tuple[float, float]]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float | None:
        if len(self) >= KNOWN:
            self.clear()
        found = [x for x in map(self.weights.get, features(word)) if x]
        value = self[word] = max(found)[1] if found else None
        return value


@dataclass
class Model:
    weights: dict[str, tuple[float, float]] = field(default_factory=dict)  # z and value of a token
    drift: float = 0.5
    rate: float = 0.0  # lambda; 0: there is no toxic token
    k: float = 1.0
    alpha: float = 0.05  # expected number of chance segments below which one is significant
    offset: float = -math.inf
    slope: float = 0.0

    def __post_init__(self):
        self.values = Values(self.weights)

    def __reduce__(self):  # what a worker remembers stays with it
        return Model, (self.weights, self.drift, self.rate, self.k, self.alpha, self.offset, self.slope)

    def segments(self, words: list[str]) -> list[tuple[int, int, float]]:
        """Maximal segments as (first token, last token, score)."""
        hits = [(i, w) for i, w in enumerate(map(self.values.__getitem__, words)) if w is not None]
        if not any(w > 0 for _, w in hits):
            return []
        items, at = [], 0
        for i, w in hits:
            if i > at:
                items.append((at, i - 1, -self.drift * (i - at)))
            items.append((i, i, w))
            at = i + 1
        return maximal_segments(items)

    def expected(self, score: float, n: int) -> float:
        return self.k * n * math.exp(-min(self.rate * score, 700.0))

    def significant(self, words: list[str]) -> list[tuple[int, int, float, float]]:
        out = [(a, b, s, self.expected(s, len(words))) for a, b, s in self.segments(words)]
        return [x for x in out if x[3] < self.alpha]

    def evidence(self, text: str | None) -> float:
        if not text or not self.rate:
            return 0.0
        return min(MOST, sum(-math.log(e) for *_, e in self.significant(tokens(text))))

    def probability(self, evidence: float) -> float:
        x = self.offset + self.slope * evidence
        return 1 / (1 + math.exp(-x)) if x > -700 else 0.0

    def passages(self, text: str | None) -> list[tuple[int, int, float, float]]:
        """Significant segments as (start, end) code points of the text, score and expected number."""
        if not text or not self.rate:
            return []
        lower = text.lower()
        if len(lower) != len(text):  # lower-casing moved positions; characters that grow are left as they are
            lower = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
        spans = [m.span() for m in _TOKEN.finditer(lower)]
        found = self.significant([lower[a:b] for a, b in spans])
        return [(spans[a][0], spans[b][1], s, e) for a, b, s, e in found]


def _counts(train: DataFrame) -> DataFrame:
    """(token, toxic, clean): texts of either kind that have the token."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (Counter(), Counter())

        def out() -> pa.RecordBatch:
            words = list(held[0] | held[1])
            columns = [words, [held[1][w] for w in words], [held[0][w] for w in words]]
            for c in held:
                c.clear()
            kinds = (pa.string(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["token", "toxic", "clean"])

        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1), strict=True):
                held[toxic.as_py()].update({f for w in set(tokens(text.as_py())) for f in features(w)})
                if len(held[0]) + len(held[1]) > HELD:
                    yield out()
        yield out()

    parts = train.select("text", "toxic").mapInArrow(count, "token string, toxic long, clean long")
    return parts.groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _moment_rate(scores: list[tuple[float, float]]) -> float:
    """The positive root of sum p exp(rate s) = 1; 0 if no score is positive or their mean is not negative."""
    whole = sum(p for p, _ in scores)
    scores = [(p / whole, s) for p, s in scores]
    if not any(s > 0 and p > 0 for p, s in scores) or sum(p * s for p, s in scores) >= 0:
        return 0.0
    total = lambda r: sum(p * math.exp(min(r * s, 700.0)) for p, s in scores)
    low, high = 1e-6, 1e-3
    while total(high) < 1:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if total(mid) < 1 else (low, mid)
    return low


def _curve(bins: list[tuple[float, float, float]]) -> tuple[float, float]:
    """Offset and slope of a logistic curve through (evidence, toxic, clean), by damped Newton steps."""
    a = b = 0.0
    for _ in range(100):
        g0 = g1 = h00 = h01 = h11 = 0.0
        for x, toxic, clean in bins:
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * x))))
            n, rest = toxic + clean, toxic - (toxic + clean) * p
            v = n * p * (1 - p)
            g0, g1, h00, h01, h11 = g0 + rest, g1 + rest * x, h00 + v, h01 + v * x, h11 + v * x * x
        g1, h00, h11 = g1 - 0.01 * b, h00 + 1e-6, h11 + 0.01  # a weak prior keeps a clear-cut slope finite
        det = h00 * h11 - h01 * h01
        if det <= 1e-12:
            break
        da, db = (h11 * g0 - h01 * g1) / det, (h00 * g1 - h01 * g0) / det
        scale = min(1.0, 2.0 / max(abs(da), abs(db), 1e-9))
        a, b = a + scale * da, max(0.0, b + scale * db)
        if max(abs(da), abs(db)) < 1e-8:
            break
    return a, b


def fit(
    train: DataFrame,
    text: str = "text",
    toxic: str = "toxic",
    prior: float = 10_000.0,
    least_z: float = 4.0,
    drift: float = 0.5,
    alpha: float = 0.05,
) -> Model:
    """Learn from all rows of ``train`` that have a text and a label of 0 or 1."""
    rows = train.where(F.col(text).isNotNull() & F.col(toxic).isin(0, 1))
    rows = rows.select(F.col(text).alias("text"), F.col(toxic).cast("int").alias("toxic"))
    counts = written(_counts(rows), "tokens")
    n_toxic, n_clean = counts.agg(F.sum("toxic"), F.sum("clean")).first()
    if not n_toxic or not n_clean:
        return Model()
    share = F.lit(float(prior)) * (F.col("toxic") + F.col("clean")) / (n_toxic + n_clean)
    odds = lambda own, n: F.log((own + share) / (F.lit(n + prior) - own - share))
    scored = counts.withColumn("delta", odds(F.col("toxic"), n_toxic) - odds(F.col("clean"), n_clean))
    scored = scored.withColumn("error", F.sqrt(1 / (F.col("toxic") + share) + 1 / (F.col("clean") + share)))
    scored = scored.withColumn("z", F.abs("delta") / F.col("error")).where(F.col("z") >= least_z)
    best = scored.select("token", "z", "delta", "error", "clean").orderBy(F.desc("z"), "token").toArrow().to_pylist()  # all significant ones
    sign = lambda r: r["delta"] - math.copysign(r["error"], r["delta"])
    model = Model({r["token"]: (r["z"], sign(r)) for r in best}, drift, alpha=alpha)
    known = sum(r["clean"] for r in best)
    # a token that no clean text has shown counts as shown once
    model.rate = _moment_rate([(max(r["clean"], 1) / n_clean, sign(r)) for r in best] + [(1 - known / n_clean, -drift)])

    @F.pandas_udf("n long, best double, evidence double")
    def scan(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in series:
            out = []
            for t in texts:
                words = tokens(t)
                found = [s for *_, s in model.segments(words)]
                out.append((len(words), max(found, default=0.0), 0.0))
            yield pd.DataFrame(out, columns=["n", "best", "evidence"])

    if model.rate:
        clean = rows.where("toxic = 0").select(scan("text").alias("s")).where("s.n > 0")
        seen = clean.agg(F.count("*").alias("n"), F.sum(F.col("s.n") * F.exp(-model.rate * F.col("s.best"))).alias("sum"))
        n, total = seen.first()
        model.k = n / total if n and total else 1.0
    bins = rows.select("toxic", F.floor(evidence(model, F.col("text")) * BINS_A_UNIT).alias("bin"))
    bins = bins.groupBy("bin").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean")).collect()
    model.offset, model.slope = _curve([(r["bin"] / BINS_A_UNIT, r["toxic"], r["clean"]) for r in bins])
    return model


def evidence(model: Model, text: Column) -> Column:
    @F.pandas_udf("double")
    def gathered(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in series:
            yield pd.Series([model.evidence(t) for t in texts], dtype="float64")

    return gathered(text)


def score(docs: DataFrame, model: Model, text: str = "text", column: str = "score") -> DataFrame:
    """``docs`` with the probability that the text is toxic."""

    @F.pandas_udf("double")
    def scored(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in series:
            yield pd.Series([model.probability(model.evidence(t)) for t in texts], dtype="float64")

    return docs.withColumn(column, scored(F.col(text)))


def passages(docs: DataFrame, model: Model, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, start, end, score, expected, passage), a row for each significant toxic passage."""

    @F.pandas_udf("array<struct<start: long, end: long, score: double, expected: double>>")
    def found(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        names = ("start", "end", "score", "expected")
        for texts in series:
            yield pd.Series([[dict(zip(names, p, strict=True)) for p in model.passages(t)] for t in texts])

    rows = docs.select(F.col(id_column), F.col(text).alias("_text"), F.explode(found(F.col(text))).alias("p"))
    passage = F.substring(F.col("_text"), (F.col("p.start") + 1).cast("int"), (F.col("p.end") - F.col("p.start")).cast("int"))
    return rows.select(id_column, "p.*", passage.alias("passage"))
