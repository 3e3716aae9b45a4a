"""Decoding topic records and encoding rows for topics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CORRUPT = "_corrupt_record"


def decode_envelope(df: DataFrame) -> DataFrame:
    """Key and value as text; the other envelope columns as they are."""
    return df.withColumns({"key": F.col("key").cast("string"), "value": F.col("value").cast("string")})


def parse_topic(df: DataFrame, schema: str, keep: Sequence[str] = ("key",)) -> DataFrame:
    """JSON values as flat columns.  Malformed values keep their row, with NULL fields.

    ``keep`` names envelope columns to carry.  Fields nobody reads later are not even parsed:
    Catalyst narrows the JSON schema to the selected ones.
    """
    decoded = decode_envelope(df)
    return decoded.select(*keep, F.from_json("value", schema).alias("data")).select(*keep, "data.*")


def with_event_time(df: DataFrame, column: str = "timestamp", name: str = "event_time") -> DataFrame:
    """Add an event time parsed from ISO text; unparsable text gives NULL, not an error."""
    return df.withColumn(name, F.try_to_timestamp(F.col(column).cast("string")))


def with_epoch_time(df: DataFrame, column: str = "timestamp", name: str = "event_time") -> DataFrame:
    """Add an event time from epoch seconds."""
    return df.withColumn(name, F.timestamp_seconds(F.col(column)))


def with_date(df: DataFrame, column: str = "event_time", name: str = "date") -> DataFrame:
    return df.withColumn(name, F.to_date(column))


def with_processing_time(df: DataFrame, name: str = "processing_time") -> DataFrame:
    return df.withColumn(name, F.current_timestamp())


def split_valid(df: DataFrame, schema: str, keep: Sequence[str] = ("key",)) -> tuple[DataFrame, DataFrame]:
    """(valid rows as flat columns, quarantined rows with their raw ``value``)."""
    decoded = decode_envelope(df)
    parsed = decoded.withColumn(
        "data",
        F.from_json("value", f"{schema}, {CORRUPT} STRING", {"columnNameOfCorruptRecord": CORRUPT}),
    )
    bad = F.col("data").isNull() | F.col(f"data.{CORRUPT}").isNotNull()
    valid = parsed.where(~bad).select(*keep, "data.*").drop(CORRUPT)
    return valid, parsed.where(bad).select(*keep, "value")


def enrich_or_pass(df: DataFrame, column: str = "value", processed_at: Column | None = None) -> DataFrame:
    """Mark JSON objects as processed, with the time as epoch seconds; pass any other value through.

    The VARIANT type keeps fields unknown to us, with their JSON types.
    """
    at = processed_at if processed_at is not None else F.current_timestamp()
    added = F.create_map(
        F.lit("processed"),
        F.lit(True).cast("variant"),
        F.lit("processed_timestamp"),
        (F.unix_micros(at.cast("timestamp")) / 1e6).cast("variant"),
    )
    raw = F.col(column).cast("string")
    variant = F.try_parse_json(raw)
    is_object = F.schema_of_variant(variant).startswith("OBJECT")
    fields = F.when(is_object, variant).cast("map<string,variant>")
    others = F.map_filter(fields, lambda k, _: ~k.isin("processed", "processed_timestamp"))
    return df.withColumn(column, F.coalesce(F.to_json(F.map_concat(others, added)), raw))


def route(
    df: DataFrame, column: str, routes: Mapping[str, Sequence[str]], other: str = "unknown"
) -> DataFrame:
    """Add ``route``: the name whose value list holds ``column``, else ``other``."""
    label = F
    for name, values in routes.items():
        label = label.when(F.col(column).isin(*values), F.lit(name))
    return df.withColumn("route", label.otherwise(F.lit(other)))


# The message kinds of the raw feed.
FEED_ROUTES = {"stock": ["stock_price"], "news": ["news", "reddit"]}


def split_routes(df: DataFrame, column: str = "data_type") -> dict[str, DataFrame]:
    """One frame per feed route, each a filter over the same input."""
    routed = route(df, column, FEED_ROUTES)
    return {name: routed.where(F.col("route") == name).drop("route") for name in (*FEED_ROUTES, "unknown")}


def fill_missing(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Default for missing (NULL) fields, and for columns the input does not have at all."""
    return df.withColumns(
        {
            name: F.coalesce(F.col(name), F.lit(value)) if name in df.columns else F.lit(value)
            for name, value in defaults.items()
        }
    )


def to_topic(df: DataFrame, key: Column | str, cols: Sequence[str] | None = None) -> DataFrame:
    """``key`` and JSON ``value`` columns, ready for a topic sink."""
    key = F.col(key) if isinstance(key, str) else key
    payload = F.struct(*[F.col(c) for c in (cols or df.columns)])
    return df.select(key.cast("string").alias("key"), F.to_json(payload).alias("value"))


def flatten_window(df: DataFrame, iso: bool = True) -> DataFrame:
    """Replace a ``window`` struct by ``window_start``/``window_end``, as ISO text or timestamps."""

    def side(name: str) -> Column:
        edge = F.col(f"window.{name}")
        return F.date_format(edge, "yyyy-MM-dd'T'HH:mm:ss") if iso else edge

    rest = [c for c in df.columns if c != "window"]
    return df.select(side("start").alias("window_start"), side("end").alias("window_end"), *rest)
