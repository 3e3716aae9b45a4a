"""Key to partition rules that every engine computes alike."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickstone.functions import stable_bucket

# Region prefixes with a partition of their own.
REGION_RULES = {"KR": 0, "US": 1, "JP": 2}


def assign_partition(
    df: DataFrame,
    key: str,
    n: int,
    rules: Mapping[str, int] | None = None,
    default: int = 0,
    name: str = "partition",
) -> DataFrame:
    """Add the partition of every row: by key prefix if a rule matches, else by stable hash.

    A NULL key goes to ``default``.
    """
    number = F.when(F.col(key).isNull(), F.lit(default))
    for prefix, target in (rules or {}).items():
        number = number.when(F.col(key).cast("string").startswith(prefix), F.lit(target))
    return df.withColumn(name, number.otherwise(stable_bucket(key, n)).cast("int"))


def co_locate(df: DataFrame, key: str, n: int | None = None) -> DataFrame:
    """Put equal keys into the same Spark partition."""
    return df.repartition(n, key) if n else df.repartition(key)


def partition_distribution(df: DataFrame, key: str, partition: str = "partition") -> DataFrame:
    """Rows per partition and key."""
    return df.groupBy(partition, key).agg(F.count(F.lit(1)).alias("count"))
