"""Bounded table sources."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from tickstone.operators.filters import in_range

# With these four Spark reads a JDBC table in parallel; without them in one task.
JDBC_PARALLEL = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")


def read_table(
    spark: SparkSession,
    path: str | None = None,
    jdbc: Mapping[str, str] | None = None,
    default_path: str | None = None,
    start: date | datetime | str | None = None,
    end: date | datetime | str | None = None,
    column: str = "date",
) -> DataFrame:
    """Rows from JDBC options if given, else parquet at ``path``, else at ``default_path``.

    The inclusive bounds compare the stored column itself, so JDBC and parquet evaluate them.
    """
    if jdbc:
        given = [name for name in JDBC_PARALLEL if name in jdbc]
        if given and len(given) < len(JDBC_PARALLEL):
            missing = sorted(set(JDBC_PARALLEL) - set(given))
            raise ValueError(f"a parallel JDBC read also needs {missing}")
        frame = spark.read.format("jdbc").options(**jdbc).load()
    elif path or default_path:
        frame = spark.read.parquet(path or default_path)
    else:
        raise ValueError("no source: give a path, JDBC options or a default path")
    return in_range(frame, column, start, end)


def in_memory(spark: SparkSession, rows: Iterable[tuple], columns: Sequence[str] | str) -> DataFrame:
    """Literal rows, for reference data and demos."""
    return spark.createDataFrame(list(rows), columns)
