"""Row filters.  Each compares the stored column itself so that the scan can evaluate it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickstone.functions import literal


def in_range(df: DataFrame, column: str, lo=None, hi=None) -> DataFrame:
    """Inclusive range; each bound is optional."""
    for bound, keeps in ((lo, F.col(column).__ge__), (hi, F.col(column).__le__)):
        if bound is not None:
            df = df.where(keeps(literal(bound, df.schema[column].dataType)))
    return df


def in_days(df: DataFrame, column: str, first=None, last=None) -> DataFrame:
    """Whole days: ``[first, last + 1 day)`` on a timestamp, so the last day keeps its intraday rows."""
    if first is not None:
        df = df.where(F.col(column) >= F.lit(first).cast("date").cast(df.schema[column].dataType))
    if last is not None:
        after = F.date_add(F.lit(last).cast("date"), 1).cast(df.schema[column].dataType)
        df = df.where(F.col(column) < after)
    return df


def in_keys(df: DataFrame, column: str, keys: Sequence | str) -> DataFrame:
    """Rows whose key is listed; a string is split at commas.  An empty list keeps everything."""
    if isinstance(keys, str):
        keys = [k.strip() for k in keys.split(",") if k.strip()]
    return df.where(F.col(column).isin(*keys)) if keys else df


def key_range(df: DataFrame, column: str, key, ts: str, lo, hi) -> DataFrame:
    """Rows of one key between two times, newest first."""
    return in_range(df.where(F.col(column) == F.lit(key)), ts, lo, hi).orderBy(F.desc(ts))


# Days per look-back period; any other period means one week.
LOOK_BACK_DAYS = {"1D": 1, "1W": 7, "1M": 30, "3M": 90}


def look_back(df: DataFrame, ts: str, period: str, anchor=None) -> DataFrame:
    """Rows of the last ``period`` before ``anchor`` (default: the newest row), bounds included."""
    days = LOOK_BACK_DAYS.get(period, LOOK_BACK_DAYS["1W"])
    end = literal(anchor, df.schema[ts].dataType) if anchor is not None else df.agg(F.max(ts)).scalar()
    return df.where(F.col(ts) >= end - F.make_dt_interval(F.lit(days)))


def only(df: DataFrame, predicate: Column | str) -> DataFrame:
    return df.where(predicate)


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    """Fail when there are no rows.  Reads at most one row, never counts."""
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df


# Moods after the last treat that call for a walk.
WALK_MOODS = ("zoomy", "bouncy")


def trigger_rows(df: DataFrame, moods: Sequence[str] = WALK_MOODS) -> DataFrame:
    """Last message of a series whose mood is listed; rows with missing fields do not match."""
    hit = F.col("final_treat") & F.col("pet_mood_post_treat").isin(*moods) & F.col("pet_name").isNotNull()
    return df.where(hit).select("pet_name", "pet_mood_post_treat")
