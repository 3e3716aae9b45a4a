"""From raw documents to a training mix: five stages, each on all that the one before kept.

Toxic documents go; passages of 50 words and more that stood before are cut out, and documents of which nothing is left
go; of near duplicates (five-word shingles, similarity of 0.8) one stays; documents that hold a benchmark item go; what
remains is mixed to the sources' target weights.  Stages read and return the columns of ``documents``; ``n_chars``
follows the text.  The last one adds size, source_size, target, copies and taken to the documents it takes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickstone.llm import containment, jaccard, lines, mixing, toxicity
from tickstone.llm.common import n_words, small_batches, table, written
from tickstone.llm.queries import labelled

TOXIC = 0.7

#: The classifier and the random numbers have no SQL counterpart; tests compare the stages with plain versions.
ORACLE_SQL = None


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    model = toxicity.fit(labelled(docs, table(spark, sf_dir, "labels")))
    scored = toxicity.score(docs, model, column="_toxicity")
    return scored.where(F.col("_toxicity") < TOXIC).drop("_toxicity")


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = lines.deduplicated(docs, removed="_removed")
    out = out.where((F.col("_removed") == 0) | (n_words(F.col("text")) > 0))
    n_chars = F.when(F.col("_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", n_chars.cast("long")).select(docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return jaccard.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return containment.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, n_words(F.col("text"))).where("copies > 0")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("jaccard_join", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("source_mix", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
