"""Time-window aggregates for batches and streams, and the z-score detector built on them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickstone.functions import micros
from tickstone.operators.parse import flatten_window

STATS = ("count", "avg", "stddev", "max", "min")

_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400, "week": 604_800}


def duration(text: str) -> timedelta:
    """``"10 seconds"`` as a timedelta."""
    number, unit = text.split()
    return timedelta(seconds=float(number) * _UNITS[unit.rstrip("s")])


def watermarked(df: DataFrame, ts: str, delay: str | None) -> DataFrame:
    """Set a watermark on a stream; a batch is complete and needs none."""
    return df.withWatermark(ts, delay) if delay and df.isStreaming else df


def _direct(value: str) -> dict[str, Column]:
    return {
        "count": F.count(F.lit(1)),
        "avg": F.avg(value),
        "stddev": F.stddev_samp(value),
        "max": F.max(value),
        "min": F.min(value),
    }


def _names(value: str) -> dict[str, str]:
    return {stat: "count" if stat == "count" else f"{stat}_{value}" for stat in STATS}


def window_stats(
    df: DataFrame,
    ts: str,
    keys: Sequence[str],
    value: str,
    size: str,
    slide: str | None = None,
    stats: Sequence[str] = STATS,
    watermark: str | None = None,
) -> DataFrame:
    """Statistics of ``value`` per time window and key, with a ``window`` struct column.

    Sliding windows of a batch are built from panes: rows are reduced once per slide interval, and
    only the few panes are copied into the windows that contain them.  A stream keeps the plain
    form, which works in every output mode.
    """
    df = watermarked(df, ts, watermark)
    if not has_panes(df, size, slide):
        chosen = [_direct(value)[s].alias(_names(value)[s]) for s in stats]
        return df.groupBy(F.window(ts, size, slide).alias("window"), *keys).agg(*chosen)
    return _from_panes(df, ts, keys, value, size, slide, stats)


def has_panes(df: DataFrame, size: str, slide: str | None) -> bool:
    """Whether windows of this batch can be put together from panes of one slide interval."""
    return bool(slide) and slide != size and not df.isStreaming and not duration(size) % duration(slide)


def pane(ts: str, slide: str) -> Column:
    """Number of the slide interval a row lies in."""
    step = int(duration(slide).total_seconds() * 1_000_000)
    return F.floor(micros(ts) / F.lit(step)).cast("bigint")


def pane_starts(column: str, size: str, slide: str) -> Column:
    """One row per window that contains the pane: the number of the window's first pane."""
    panes = duration(size) // duration(slide)
    return F.explode(F.sequence(F.col(column) - (panes - 1), F.col(column)))


def pane_window(column: str, size: str, slide: str, like: DataFrame, ts: str) -> Column:
    """The ``window`` struct for a first-pane number, with edges of the type of ``ts``."""
    step = int(duration(slide).total_seconds() * 1_000_000)
    panes = duration(size) // duration(slide)
    kind = like.schema[ts].dataType
    edges = [
        F.timestamp_micros((F.col(column) + k) * step).cast(kind).alias(n)
        for k, n in ((0, "start"), (panes, "end"))
    ]
    return F.struct(*edges).alias("window")


def _from_panes(df, ts, keys, value, size, slide, stats) -> DataFrame:
    needed = {
        "_rows": F.count(F.lit(1)) if "count" in stats else None,
        "_n": F.count(value) if {"avg", "stddev"} & set(stats) else None,
        "_sum": F.sum(value) if {"avg", "stddev"} & set(stats) else None,
        "_var": F.var_pop(value) if "stddev" in stats else None,
        "_max": F.max(value) if "max" in stats else None,
        "_min": F.min(value) if "min" in stats else None,
    }
    partial = {name: column for name, column in needed.items() if column is not None}
    reduced = df.groupBy(pane(ts, slide).alias("_pane"), *keys).agg(*[c.alias(n) for n, c in partial.items()])
    spread = reduced.select(pane_starts("_pane", size, slide).alias("_start"), *keys, *partial)
    total, seen = F.sum("_sum"), F.sum("_n")
    # The deviation needs each pane's own spread: at most size / slide small structs per window.
    parts = F.collect_list(F.when(F.col("_n") > 0, F.struct("_n", "_sum", "_var")))
    combined = {
        "count": lambda: F.sum("_rows"),
        "avg": lambda: F.try_divide(total, seen),
        "stddev": lambda: _pooled(parts, F.try_divide(total, seen), seen),
        "max": lambda: F.max("_max"),
        "min": lambda: F.min("_min"),
    }
    names = _names(value)
    grouped = spread.groupBy("_start", *keys).agg(*[combined[s]().alias(names[s]) for s in stats])
    return grouped.select(
        pane_window("_start", size, slide, df, ts), *keys, *[names[s] for s in stats]
    )


def _pooled(parts: Column, mean: Column, seen: Column) -> Column:
    """Sample deviation of several groups from their sizes, sums and own variances."""

    def add(acc: Column, p: Column) -> Column:
        gap = p["_sum"] / p["_n"] - mean
        return acc + p["_n"] * (p["_var"] + gap * gap)

    squares = F.aggregate(parts, F.lit(0.0), add)
    return F.when(seen > 1, F.sqrt(squares / (seen - 1)))


def tumbling(df, ts, keys, value, size="10 seconds", stats=("avg", "max", "min", "count"), watermark=None):
    """Fixed windows; by default the 10-second device statistics."""
    return window_stats(df, ts, keys, value, size, stats=stats, watermark=watermark)


def sliding(
    df, ts, keys, value, size="30 seconds", slide="10 seconds", stats=("avg", "stddev"), watermark=None
):
    """Overlapping windows; by default the 30-second average and deviation every 10 seconds."""
    return window_stats(df, ts, keys, value, size, slide, stats, watermark)


def hourly(df: DataFrame, ts: str, key: str, watermark: str | None = None, size: str = "1 hour") -> DataFrame:
    """Rows per hour and key."""
    df = watermarked(df, ts, watermark)
    return df.groupBy(F.window(ts, size).alias("window"), key).agg(F.count(F.lit(1)).alias("count"))


def throughput(df: DataFrame, ts: str, bucket: str = "1 minute") -> DataFrame:
    """Rows per second in every time bucket."""
    seconds = duration(bucket).total_seconds()
    counted = df.groupBy(F.window(ts, bucket).alias("window")).agg(F.count(F.lit(1)).alias("messages"))
    return counted.withColumn("per_second", F.col("messages") / F.lit(seconds))


# Fixed value: stands in for a missing or zero deviation.
SIGMA_FLOOR = 0.001


def detect_anomalies(
    df: DataFrame,
    ts: str = "event_time",
    key: str = "device_id",
    value: str = "value",
    size: str = "30 seconds",
    slide: str | None = "10 seconds",
    sigma: float = 2.0,
    watermark: str | None = "30 seconds",
) -> DataFrame:
    """Windows whose extreme values lie more than ``sigma`` deviations from the window's average.

    In a window of n rows no value can be further out than ``(n - 1) / sqrt(n)`` deviations.
    """
    return score_windows(window_stats(df, ts, [key], value, size, slide, watermark=watermark), value, sigma)


def score_windows(stats: DataFrame, value: str = "value", sigma: float = 2.0) -> DataFrame:
    """The scores of :func:`detect_anomalies` for windows with all statistics."""
    flat = flatten_window(stats, iso=False)
    avg, low, high = F.col(f"avg_{value}"), F.col(f"min_{value}"), F.col(f"max_{value}")
    spread = F.coalesce(F.nullif(F.col(f"stddev_{value}"), F.lit(0.0)), F.lit(SIGMA_FLOOR))
    scored = flat.withColumn(f"stddev_{value}", spread)
    spread = F.col(f"stddev_{value}")
    scored = scored.withColumns({"z_score_max": (high - avg) / spread, "z_score_min": (low - avg) / spread})
    flagged = scored.withColumns(
        {
            "is_anomaly_high": F.col("z_score_max") > sigma,
            "is_anomaly_low": F.col("z_score_min") < -sigma,
        }
    )
    return flagged.withColumns(
        {
            "is_anomaly": F.col("is_anomaly_high") | F.col("is_anomaly_low"),
            "anomaly_type": F.when(F.col("is_anomaly_high"), "HIGH_VALUE")
            .when(F.col("is_anomaly_low"), "LOW_VALUE")
            .otherwise("NORMAL"),
            "anomaly_score": F.when(F.col("is_anomaly_high"), F.col("z_score_max"))
            .when(F.col("is_anomaly_low"), F.abs("z_score_min"))
            .otherwise(0.0),
        }
    )


def anomaly_alerts(anomalies: DataFrame, key: str = "device_id", value: str = "value") -> DataFrame:
    """The anomalous windows, as alert rows."""
    return anomalies.where("is_anomaly").select(
        "window_start",
        "window_end",
        key,
        "anomaly_type",
        "anomaly_score",
        f"avg_{value}",
        f"max_{value}",
        f"min_{value}",
    )
