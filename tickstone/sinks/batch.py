"""Batch sinks.  Every one writes from the executors; nothing is gathered on the driver."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickstone.operators.parse import to_topic
from tickstone.operators.report import ticker_documents


def default_path(run_date: date | None = None) -> str:
    return f"stock_analysis_results_{(run_date or date.today()):%Y%m%d}"


def save(
    df: DataFrame,
    path: str | None = None,
    fmt: str = "parquet",
    documents: bool = False,
) -> str:
    """Overwrite ``path`` with parquet, CSV (with header) or JSON lines; returns the path.

    ``documents`` turns a market summary into one nested document per ticker first.
    """
    path = path or default_path()
    fmt = fmt.lower()
    if fmt not in ("parquet", "csv", "json"):
        raise ValueError(f"unknown format: {fmt}")
    if documents:
        df = ticker_documents(df)
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
    return path


def as_table(df: DataFrame, schema: str) -> DataFrame:
    """The columns of a declared table, cast to its types (decimals, dates) on the way out."""
    target = df.sparkSession.createDataFrame([], schema).schema
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.fields])


def write_jdbc(
    df: DataFrame, options: Mapping[str, str], mode: str = "append", schema: str | None = None
) -> None:
    """Append to or overwrite a JDBC table; ``numPartitions`` in the options bounds the connections."""
    if mode not in ("append", "overwrite"):
        raise ValueError("mode must be 'append' or 'overwrite'")
    rows = as_table(df, schema) if schema else df
    rows.write.format("jdbc").options(**options).mode(mode).save()


def append_rows(df: DataFrame, target: str, schema: str) -> None:
    """Append rows to a parquet table with the declared columns and precision."""
    as_table(df, schema).write.mode("append").parquet(target)


def write_topic(df: DataFrame, key: str, fmt: str, options: Mapping[str, str]) -> None:
    """Batch write of every column as JSON to a topic (``kafka``), or to files of the same shape."""
    to_topic(df, key).write.format(fmt).options(**options).mode("append").save()
