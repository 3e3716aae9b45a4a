"""Helpers shared by the training-data operators."""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickstone.plans.scratch import work_dir

WORDS = "[^\\x20\\x09-\\x0D]+"  # a word of the contracts: a run without space, tab and line ends


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


FILES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` computed once into a table of the shared folder, for results that several steps read.

    What was shuffled for it is deleted with the last task, not when the driver's collector comes by.
    """
    spark = df.sparkSession
    path = work_dir(spark, label)
    before = spark.conf.get(FILES_GO, None)
    spark.conf.set(FILES_GO, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(FILES_GO) if before is None else spark.conf.set(FILES_GO, before)
    return spark.read.schema(df.schema).parquet(path)


def collected(spark: SparkSession) -> None:
    """Have the driver's collector find the shuffles that nothing refers to any more, so that Spark deletes their files.

    Those of the last execution count as referred to until another one has run.
    """
    spark.sparkContext._jvm.System.gc()


def fold(id_column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; NULL for a NULL id."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % folds


FILTER_BITS = 1 << 22


def bitmap(rows: DataFrame, column: str) -> np.ndarray:
    """Which of ``FILTER_BITS`` hash values the ids of ``rows`` have; only the map's words pass through the driver."""
    words = rows.select(_bit(column).alias("bit")).groupBy(F.shiftright("bit", 5).alias("word"))
    words = words.agg(F.expr("bit_or(shiftleft(1L, cast(bit % 32 as int)))").alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS // 32, dtype=np.uint32)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().astype(np.uint32)
    return out


def _bit(column: str) -> Column:
    return F.pmod(F.xxhash64(F.col(column).cast("long")), F.lit(FILTER_BITS))


def may_match(docs: DataFrame, wanted: DataFrame, column: str) -> DataFrame:
    """The rows of ``docs`` whose id may be in ``wanted``, by a bitmap of fixed size, without a shuffle of ``docs``.

    A row that it keeps by chance finds no partner in the join that follows.
    """
    known, names = bitmap(wanted, column), docs.columns

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            hit = (known[at >> 5] >> (at & 31).astype(np.uint32)) & np.uint32(1)
            yield pa.RecordBatch.from_arrays(batch.filter(pa.array(hit.astype(bool))).columns[:-1], names)

    return docs.withColumn("_bit", _bit(column)).mapInArrow(keep, docs.schema)


BYTES_A_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession, size: str = "4m") -> None:
    """Bound the bytes that go to a Python worker at once, unless the session has a bound.

    Without it, a batch has ten thousand rows, however long their texts are.
    """
    if BYTES_A_BATCH not in spark.conf.getAll:
        spark.conf.set(BYTES_A_BATCH, size)


def lowered(text: Column) -> Column:
    """``text`` with A-Z, and nothing else, in lower case."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def text_batches(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches with about ``limit`` bytes of text each (one text at least), to bound memory."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        sizes = pa.compute.binary_length(batch.column(at)).fill_null(0).to_numpy(zero_copy_only=False)
        first, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(first, i - first)
                first, held = i, 0
            held += int(size)
        if first < batch.num_rows:
            yield batch.slice(first)
