"""Grouped aggregates.  All are algebraic, so Spark reduces each group before it shuffles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickstone.functions import literal
from tickstone.operators.windows import has_panes, pane, pane_starts, pane_window, watermarked


def count_by(df: DataFrame, keys: Sequence[str], name: str = "count", ordered: bool = True) -> DataFrame:
    """Rows per key.  With one key the most frequent first; with more, by the leading keys first."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    if not ordered:
        return counted
    return counted.orderBy(*[F.asc(k) for k in keys[:-1]], F.desc(name), F.asc(keys[-1]))


def minute_counts(df: DataFrame, ts: str, key: str, anchor=None, days: int = 1) -> DataFrame:
    """Rows per minute and key over the last ``days`` before ``anchor`` (default: the newest row)."""
    end = literal(anchor, df.schema[ts].dataType) if anchor is not None else df.agg(F.max(ts)).scalar()
    recent = df.where(F.col(ts) > end - F.make_dt_interval(F.lit(days)))
    bucket = F.date_trunc("minute", ts).cast(df.schema[ts].dataType).alias("bucket")
    return recent.groupBy(bucket, key).agg(F.count(F.lit(1)).alias("cnt"))


def merge_counts(old: DataFrame, new: DataFrame, keys: Sequence[str], value: str = "cnt") -> DataFrame:
    """Upsert: every old and new key once, with the new value where there is one."""
    none = F.lit(None).cast(new.schema[value].dataType)
    both = old.select(*keys, F.col(value).alias("_old"), none.alias("_new")).unionByName(
        new.select(*keys, none.alias("_old"), F.col(value).alias("_new"))
    )
    return both.groupBy(*keys).agg(F.coalesce(F.max("_new"), F.max("_old")).alias(value))


def daily_sentiment(df: DataFrame, ts: str = "timestamp", score: str = "sentiment_score") -> DataFrame:
    """Mean score and first timestamp per day."""
    return df.groupBy(F.to_date(ts).alias("date")).agg(
        F.avg(score).alias("avg_score"), F.min(ts).alias("first_timestamp")
    )


def order_rollup(orders: DataFrame, key: str = "order_id") -> DataFrame:
    """Item count and amount per order.

    Documents that carry parts of one order are added up.  The lines are exploded and summed in the
    same stage; of the nested products only price and quantity are read.
    """
    lines = orders.select(key, F.posexplode_outer("products").alias("position", "product"))
    amount = F.col("product.price") * F.col("product.quantity")
    return lines.groupBy(key).agg(
        F.count("position").alias("items"), F.coalesce(F.sum(amount), F.lit(0)).alias("amount")
    )


def order_lines(orders: DataFrame, key: str = "order_id") -> DataFrame:
    """Numbered product lines of every order document."""
    numbered = orders.select(key, F.posexplode("products").alias("position", "product"))
    return numbered.select(
        key, (F.col("position") + 1).alias("line"), "product.*"
    )


def distinct_per_window(
    df: DataFrame,
    ts: str,
    key: str,
    column: str,
    size: str,
    slide: str | None = None,
    approx: bool = False,
    name: str = "distinct_count",
) -> DataFrame:
    """Distinct values of ``column`` per window and key.

    The exact form first removes repeats, then counts, so a key with very many values is never held
    in one row.  On a stream the exact form needs append mode; the approximate form keeps a sketch
    of fixed size per group and works in every mode.
    """
    counted = F.approx_count_distinct(column) if approx else F.count_distinct(column)
    if has_panes(df, size, slide) and not approx:
        seen = df.select(pane(ts, slide).alias("_pane"), key, column).distinct()
        spread = seen.select(pane_starts("_pane", size, slide).alias("_start"), key, column)
        grouped = spread.groupBy("_start", key).agg(counted.alias(name))
        return grouped.select(pane_window("_start", size, slide, df, ts), key, name)
    windowed = df.select(F.window(ts, size, slide).alias("window"), key, column)
    if df.isStreaming and not approx:
        windowed = windowed.dropDuplicates(["window", key, column])
        counted = F.count(column)
    return windowed.groupBy("window", key).agg(counted.alias(name))


# Fixed value: distinct pages from which a user counts as suspicious.
SUSPICIOUS_PAGES = 5
SKETCH_BITS = 128


def suspicious_users(
    df: DataFrame,
    ts: str = "event_timestamp",
    key: str = "user_id",
    page: str = "page_url",
    size: str = "30 seconds",
    slide: str | None = "10 seconds",
    min_pages: int = SUSPICIOUS_PAGES,
    approx: bool = False,
    watermark: str | None = "30 seconds",
) -> DataFrame:
    """Users that open at least ``min_pages`` distinct pages within a window."""
    df = watermarked(df, ts, watermark)
    counted = distinct_per_window(df, ts, key, page, size, slide, approx, "distinct_page_count")
    return counted.where(F.col("distinct_page_count") >= min_pages)


def suspicious_candidates(
    df: DataFrame,
    ts: str = "event_timestamp",
    key: str = "user_id",
    page: str = "page_url",
    size: str = "30 seconds",
    slide: str | None = "10 seconds",
    min_pages: int = SUSPICIOUS_PAGES,
    watermark: str | None = "30 seconds",
) -> DataFrame:
    """Windows and users of a stream that may be suspicious, for update mode: a distinct sketch of fixed size per group.

    The sketch is a bitmap of ``SKETCH_BITS`` hashed pages in whole numbers, so a group is three numbers of state.  It errs by
    collisions; a third of the wanted number leaves room for them, and a full bitmap is always taken.  Whoever
    has fewer rows than ``min_pages`` cannot have as many pages.
    """
    df = watermarked(df, ts, watermark).withColumn("_bit", F.pmod(F.xxhash64(page), F.lit(SKETCH_BITS)).cast("int"))
    words = range(SKETCH_BITS // 64)
    own = lambda i: F.col(page).isNotNull() & (F.shiftright("_bit", 6) == i)
    bits = [F.bit_or(F.when(own(i), F.expr("shiftleft(1L, _bit % 64)")).otherwise(F.lit(0).cast("long"))).alias(f"_bits{i}") for i in words]
    counted = df.groupBy(F.window(ts, size, slide).alias("window"), key).agg(F.count(F.lit(1)).alias("rows"), *bits)
    clear = SKETCH_BITS - sum(F.bit_count(f"_bits{i}") for i in words)
    about = -SKETCH_BITS * F.log(clear / SKETCH_BITS)
    may = (F.col("rows") >= min_pages) & ((clear == 0) | (3 * about >= min_pages))
    return counted.where(may).select("window", key)


def suspicious_exactly(
    df: DataFrame,
    candidates: DataFrame,
    ts: str = "event_timestamp",
    key: str = "user_id",
    page: str = "page_url",
    size: str = "30 seconds",
    slide: str | None = "10 seconds",
    min_pages: int = SUSPICIOUS_PAGES,
) -> DataFrame:
    """:func:`suspicious_users` of stored rows for the (window, key) ``candidates`` only, however often each is listed.

    Rows of other keys are left out before any window is formed.
    """
    named = candidates.select("window", key).distinct()
    rows = df.join(named.select(key).distinct(), key, "left_semi")
    windowed = rows.select(F.window(ts, size, slide).alias("window"), key, page).distinct()
    counted = windowed.join(named, ["window", key]).groupBy("window", key).agg(F.count(page).alias("distinct_page_count"))
    return counted.where(F.col("distinct_page_count") >= min_pages)
