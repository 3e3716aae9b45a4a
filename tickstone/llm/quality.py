"""Quality rules whose thresholds follow the data, per language and source.

Each text is measured by word and line counts.  Fixed base rules come first.  The texts that pass them fill histograms
of four rates per (language, source): bins are as wide as 1/64 of their value or 1/1000, whichever is more, so a histogram
has a bounded number of bins, and histograms are merged by adding counts: they are quantile sketches that give the same
result in any order.  Quartiles of a group set its fences, ``REACH`` spreads beyond the quartiles; a rate outside its
fences rejects the text.  A group of fewer than ``ENOUGH`` texts uses the merged sketch of its language, a language of
fewer that of everything; if that has fewer too, only the base rules hold.  Thresholds are joined to the measured rows by
(language, source).

Everything is DataFrame functions.  Rows of one group are counted per bin before the shuffle, so a hot source sends one row
per task and bin.  Repeated words are found within the row: windows of three words are sorted by hash, and those that meet an
equal hash are compared by their words.

A NULL text is measured as an empty one, and fails the base rules as does any text of fewer than 50 words.  NULL languages
and sources are groups of their own.  Equal rows are counted and judged one by one and alike.  An empty table gives no rows.
Columns of the names added here are replaced, others are kept.  A very long text is one row: its windows take 8 bytes a word
in its task.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickstone.llm.common import WORDS, written

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
BASE_WORDS, BASE_REPEATED = 50, 50
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
ENOUGH = 100
REACH = 3
BITS = 7  # leading bits of a rate that its bin keeps


class Rate(NamedTuple):
    """``part`` per 1000 ``whole``; fences are at least ``REACH * spread`` from the quartiles."""

    name: str
    part: str
    whole: str
    spread: int
    low: bool = False

    def value(self) -> Column:
        return F.expr(f"coalesce(cast({self.part} as bigint) * 1000 div {self.whole}, 0)")


RATES = [
    Rate("word_length", "word_chars", "n_words", 500, low=True),
    Rate("symbols", "n_symbols", "n_words", 30),
    Rate("repeated_words", "n_repeat_words", "n_words", 100),
    Rate("repeated_lines", "n_dup_lines", "n_lines", 150),
]


def _without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base measures and n_lines, the lines that have a word."""
    own = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(own, "\n", -1), lambda line: line.rlike(WORDS))
    out = docs.withColumn("word_chars", _without(own, SPACE).cast("long"))
    out = out.withColumn("n_symbols", (F.length(own) - _without(own, SYMBOLS)).cast("long"))
    out = out.withColumn("_lines", lines).withColumn("n_lines", F.size("_lines").cast("long"))
    out = out.withColumn("n_dup_lines", F.col("n_lines") - F.size(F.array_distinct("_lines"))).drop("_lines")
    out = _with_repeated(out.withColumn("_words", F.regexp_extract_all(own, F.lit(WORDS), F.lit(0))))
    failed = (F.col("n_words") < BASE_WORDS) | (100 * F.col("n_repeat_words") > BASE_REPEATED * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def _with_repeated(docs: DataFrame) -> DataFrame:
    """Replaces ``_words`` by n_words and n_repeat_words.

    A window's key is its hash with the position in the low bits, so that one sort of numbers brings windows that may
    be equal together; only those are sorted by their words.
    """
    words = F.col("_words")
    word = lambda at: F.get(words, at.cast("int"))
    out = docs.withColumn("n_words", F.size(words).cast("long"))
    out = out.withColumn("_bits", F.length(F.bin("n_words")))
    cut = lambda key: F.call_function("shiftright", key, F.col("_bits"))
    starts = F.when(F.col("n_words") >= 3, F.sequence(F.lit(0).cast("long"), F.col("n_words") - 3))
    starts = F.coalesce(starts, F.array().cast("array<bigint>"))
    key = lambda i: F.call_function("shiftleft", cut(F.xxhash64(word(i), word(i + 1), word(i + 2))), F.col("_bits")).bitwiseOR(i)
    out = out.withColumn("_keys", F.sort_array(F.transform(starts, key)))
    keys = F.col("_keys")
    near = lambda x, i: (cut(F.get(keys, i - 1)) == cut(x)) | (cut(F.get(keys, i + 1)) == cut(x))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_bits")) - 1
    window = lambda i: F.struct(word(i).alias("a"), word(i + 1).alias("b"), word(i + 2).alias("c"), i.alias("i"))
    out = out.withColumn("_maybe", F.transform(F.filter(keys, near), lambda x: x.bitwiseAND(mask)))
    out = out.withColumn("_maybe", F.sort_array(F.transform("_maybe", window)))
    maybe = F.col("_maybe")
    same = lambda x, y: (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])
    twice = F.filter(maybe, lambda x, i: same(x, F.get(maybe, i - 1)) | same(x, F.get(maybe, i + 1)))
    covered = F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
    out = out.withColumn("n_repeat_words", F.size(F.array_distinct(covered)).cast("long"))
    return out.drop("_words", "_bits", "_keys", "_maybe")


def _bin(value: Column) -> Column:
    """Least value of the bin: the leading ``BITS`` bits of ``value``."""
    low = F.greatest(F.length(F.bin(value)) - BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, low), low)


def sketches(measured_docs: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """(level, lang, source, rate, bin, n): histograms of the stored texts that pass the base rules, merged at three levels."""
    rates = F.array(*[F.struct(F.lit(r.name).alias("rate"), _bin(r.value()).alias("bin")) for r in RATES])
    rows = measured_docs.where(~F.col("base_failed")).select(F.col(lang).alias("lang"), F.col(source).alias("source"), F.explode(rates).alias("r"))
    finest = rows.groupBy("lang", "source", "r.rate", "r.bin").agg(F.count("*").alias("n"))
    levels = F.explode(F.sequence(F.lit(0), F.lit(2))).alias("level")
    of = lambda name, least: F.when(F.col("level") >= least, F.col(name)).alias(name)
    all_levels = finest.select("*", levels).select("level", of("lang", 1), of("source", 2), "rate", "bin", "n")
    return all_levels.groupBy("level", "lang", "source", "rate", "bin").agg(F.sum("n").alias("n"))


def fences(histograms: DataFrame) -> DataFrame:
    """(level, lang, source, n, and for each rate <name>_low and <name>_high) from the sketches' quartiles."""
    group = ["level", "lang", "source", "rate"]
    so_far = F.sum("n").over(Window.partitionBy(*group).orderBy("bin"))
    out = histograms.select("*", so_far.alias("so_far"), F.sum("n").over(Window.partitionBy(*group)).alias("total"))
    quartile = lambda k: F.min(F.when(4 * F.col("so_far") >= k * F.col("total"), F.col("bin"))).alias(f"q{k}")
    out = out.groupBy(*group).agg(quartile(1), quartile(3), F.sum("n").alias("n"))
    columns = [F.max("n").alias("n")]
    for r in RATES:
        reach = REACH * F.greatest(F.col("q3") - F.col("q1"), F.lit(r.spread))
        own = F.col("rate") == r.name
        columns.append(F.max(F.when(own, F.col("q1") - reach if r.low else -1)).cast("long").alias(f"{r.name}_low"))
        columns.append(F.max(F.when(own, F.col("q3") + reach)).cast("long").alias(f"{r.name}_high"))
    return out.groupBy("level", "lang", "source").agg(*columns)


def thresholds(histograms: DataFrame) -> DataFrame:
    """(lang, source, fences): those of the finest level with ``ENOUGH`` texts, NULL where no level has."""
    found = written(fences(histograms), "fences")
    names = [f"{r.name}_{side}" for r in RATES for side in ("low", "high")]
    packed = F.when(F.col("n") >= ENOUGH, F.struct(*names))
    level = lambda k, *keys: found.where(F.col("level") == k).select(*keys, packed.alias(f"f{k}"))
    langs = level(1, F.col("lang").alias("_lang"))
    out = level(2, "lang", "source").join(langs, F.col("lang").eqNullSafe(F.col("_lang")), "left")
    overall = level(0).first()  # one row
    overall = F.struct(*[F.lit(overall["f0"][n] if overall and overall["f0"] else None).cast("long").alias(n) for n in names])
    return out.select("lang", "source", F.coalesce("f2", "f1", overall).alias("fences")).select("lang", "source", "fences.*")


def judged(measured_docs: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Measured rows with ``kept`` and ``rule``, the first rule that rejects the row or NULL.

    The rows are written once and read twice; drop the text before if it isn't needed after.
    """
    measured_docs = written(measured_docs, "measured")
    limits = thresholds(sketches(measured_docs, lang, source))
    limits = limits.withColumnsRenamed({c: f"_{c}" for c in limits.columns})
    own = F.col(lang).eqNullSafe(F.col("_lang")) & F.col(source).eqNullSafe(F.col("_source"))
    out = measured_docs.join(limits, own, "left")
    inside = lambda r: r.value().between(F.col(f"_{r.name}_low"), F.col(f"_{r.name}_high"))
    rule = F.when(F.col("base_failed"), "base")
    rule = reduce(lambda so_far, r: so_far.when(~inside(r), r.name), RATES, rule)
    out = out.withColumn("rule", rule).drop(*limits.columns)
    return out.withColumn("kept", F.col("rule").isNull())


def filtered(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that all rules keep, in its columns."""
    return judged(measured(docs, text), lang, source).where("kept").select(docs.columns)
