"""Sorting and ranking.

``row_number() <= n`` and ``rank() = 1`` let Spark cut every key down to its best rows before the
exchange (WindowGroupLimit), so even a very large key sends only a few rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickstone.operators.windows import window_stats


def window_counts(df: DataFrame, ts: str, key: str, size: str, slide: str | None, watermark=None) -> DataFrame:
    """Rows per window and key."""
    return window_stats(df, ts, [key], key, size, slide, ("count",), watermark)


def top_global(
    df: DataFrame,
    ts: str,
    key: str,
    k: int = 5,
    size: str = "1 minute",
    slide: str | None = "5 seconds",
    watermark: str | None = "1 minute",
) -> DataFrame:
    """The first ``k`` of all (window, key) counts, newest window first, then the largest count.

    This favours the newest window; :func:`top_per_window` ranks inside each window.  On a stream
    it needs complete mode.
    """
    counts = window_counts(df, ts, key, size, slide, watermark)
    return counts.orderBy(F.desc("window"), F.desc("count"), F.asc(key)).limit(k)


def top_per_window(
    df: DataFrame, ts: str, key: str, k: int = 5, size: str = "1 minute", slide: str | None = "5 seconds"
) -> DataFrame:
    """The ``k`` most frequent keys of every window, with their ``rank``."""
    counts = window_counts(df, ts, key, size, slide)
    best = W.partitionBy("window").orderBy(F.desc("count"), F.asc(key))
    return counts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def last_n(df: DataFrame, key: str, ts: str, n: int, tie: str | None = None, of=None) -> DataFrame:
    """The newest ``n`` rows of every key, or of the key ``of`` only, newest first."""
    newest = [F.desc(ts), *([F.desc(tie)] if tie else [])]
    if of is not None:
        return df.where(F.col(key) == F.lit(of)).orderBy(*newest).limit(n)
    order = W.partitionBy(key).orderBy(*newest)
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def head(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n)


def latest_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The rows of every key at its greatest ``order``; ties are all kept."""
    newest = W.partitionBy(key).orderBy(F.desc(order))
    return df.withColumn("_rank", F.rank().over(newest)).where(F.col("_rank") == 1).drop("_rank")


def recent_baseline(
    df: DataFrame,
    key: str,
    ts: str,
    columns: Mapping[str, str | Column],
    n: int = 20,
    tie: str | None = None,
) -> DataFrame:
    """Averages of the newest ``n`` rows per key; ``columns`` maps output names to inputs.

    An input given as an expression is evaluated for the remaining rows only.
    """
    newest = last_n(df, key, ts, n, tie)
    return newest.groupBy(key).agg(*[F.avg(c).alias(o) for o, c in columns.items()])
