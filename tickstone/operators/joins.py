"""Joins.  None forces a broadcast: Spark decides by size, and adaptive execution splits skewed keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickstone.operators import mentions
from tickstone.operators.sequence import carry_forward


def asof_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    ts: str,
    value: str,
    tie: str | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Left rows with the last right ``value`` at or before their time; rows without one are dropped.

    Both sides are merged in time order per key instead of joined, cut into parts of equal size so that
    a key with very many rows is spread over tasks.  ``tie`` orders right rows of equal time.
    """
    tied = F.col(tie) if tie else F.lit(0)
    prices = right.select(key, ts, F.lit(0).alias("_side"), tied.cast("bigint").alias("_tie"), value)
    events = left.withColumns({"_side": F.lit(1), "_tie": F.lit(0).cast("bigint")})
    merged = events.unionByName(prices, allowMissingColumns=True)
    filled = carry_forward(merged, key, ts, ["_side", "_tie"], value, "_asof", True, parts)
    hits = filled.where((F.col("_side") == 1) & F.col("_asof").isNotNull())
    return hits.drop("_side", "_tie", value).withColumnRenamed("_asof", value)


def with_threshold(
    df: DataFrame, thresholds: DataFrame, key: str, default: float, name: str = "threshold"
) -> DataFrame:
    """Add the key's own threshold, or the default."""
    joined = df.join(thresholds.select(key, F.col(name).alias("_own")), key, "left")
    return joined.withColumn(name, F.coalesce("_own", F.lit(default))).drop("_own")


def committed_only(df: DataFrame, committed: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows of committed transactions only."""
    on = [key] if isinstance(key, str) else list(key)
    return df.join(committed.select(*on), on, "left_semi")


def drop_failed(df: DataFrame, payments: DataFrame, key: str, failed: str = "status = 'failed'") -> DataFrame:
    """Rows whose key has no failed payment."""
    return df.join(payments.where(failed).select(key), key, "left_anti")


def mention_join(
    posts: DataFrame,
    keywords: DataFrame,
    key: str,
    keyword: str = "ticker",
    texts: Sequence[str] = ("title", "content"),
) -> DataFrame:
    """Every (post, keyword) pair where the keyword occurs in one of the texts, ignoring case.

    Posts are told apart by their texts, so ``key`` may be NULL or repeat; see :mod:`tickstone.operators.mentions`.
    """
    if key not in posts.columns:
        raise ValueError(f"posts have no column {key}")
    return mentions.mention_join(posts, keywords, keyword, texts)
