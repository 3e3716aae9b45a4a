"""The test tables seen as ticks, device readings, clicks, topic records, orders and posts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickstone.operators.partitioning import assign_partition


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_date(column: str = "date") -> Column:
    """Dates leave the queries as text: engines disagree on how to hand out a DATE."""
    return F.col(column).cast("string").alias(column)


def cents_of(column: str) -> Column:
    """Whole cents of a price with two decimals, still DOUBLE."""
    return F.rint(F.col(column) * 100)


def daily_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as price ticks of a supplier.  Prices are whole cents, so sums are exact."""
    cents = cents_of("l_extendedprice")
    line = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("decimal(16,0)")
    items = table(spark, sf_dir, "lineitem")
    return items.select(
        F.concat(F.lit("S"), "l_suppkey").alias("ticker"),
        F.col("l_shipdate").alias("ts"),
        *[cents.alias(c) for c in ("open", "high", "low", "close")],
        F.col("l_quantity").cast("bigint").alias("volume"),
        # (order, line) repeats now and then, so the price takes part in the order as well.
        (line * F.lit(1_000_000_000).cast("decimal(10,0)") + cents.cast("decimal(9,0)"))
        .cast("decimal(25,0)")
        .alias("seq"),
    )


def payload_number() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def intraday_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as price ticks of a user."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("U"), "user_id").alias("ticker"),
        "ts",
        F.col("value").alias("price"),
        payload_number().alias("volume"),
        F.col("event_id").alias("seq"),
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as device readings; values are whole cents, so sums are exact."""
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("event_time"),
        F.col("event_type").alias("device_id"),
        cents_of("value").alias("value"),
        "event_id",
    )


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as clicks of a user on a page."""
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("click_time"),
        F.concat(F.lit("U"), "user_id").alias("user_id"),
        F.concat(F.lit("/p/"), payload_number()).alias("page_url"),
    )


def envelope(events: DataFrame) -> DataFrame:
    """Events as JSON records of a topic; every tenth value is cut short, as broken input."""
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    value = F.to_json(
        F.struct("event_id", stamp.alias("event_time"), "user_id", "event_type", "value", "props")
    )
    broken = F.col("event_id") % 10 == 3
    records = events.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.when(broken, F.substring(value, 1, 30)).otherwise(value).cast("binary").alias("value"),
        F.lit("events").alias("topic"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
        F.col("user_id").cast("string").alias("_key"),
    )
    return assign_partition(records, "_key", 3).drop("_key")


EVENT_RECORD = (
    "event_id BIGINT, event_time STRING, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)


def order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as order documents, the product listed as often as the line number says."""
    cents = cents_of("l_extendedprice").cast("bigint")
    quantity = F.col("l_quantity").cast("bigint")
    product = F.struct(
        F.concat(F.lit("P"), "l_partkey").alias("product_id"),
        cents.alias("price"),
        quantity.alias("quantity"),
        (cents * quantity).alias("amount"),
    )
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("O"), "l_orderkey").alias("order_id"),
        F.array_repeat(product, F.col("l_linenumber")).alias("products"),
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as posts: the first line is the title, the rest the content."""
    title = F.substring_index("text", "\n", 1)
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        title.alias("title"),
        F.expr("substring(text, length(substring_index(text, '\n', 1)) + 2)").alias("content"),
        "source",
        "lang",
    )


def keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first long word of every benchmark item."""
    word = F.regexp_extract("text", "[A-Za-z]{8,}", 0)
    return table(spark, sf_dir, "benchmark").select(word.alias("ticker")).where("ticker <> ''").distinct()


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the benchmark items; a word's length decides its valence, -4 to 4."""
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}']+"), F.lit(0))
    tokens = table(spark, sf_dir, "benchmark").select(F.explode(words).alias("token")).distinct()
    return tokens.withColumn("valence", F.length("token") % 9 - 4)


# The same views in SQL.
TICKS_SQL = """
ticks AS (
  SELECT 'S' || l_suppkey AS ticker, l_shipdate AS ts, round(l_extendedprice * 100) AS price,
         CAST(l_quantity AS BIGINT) AS volume, l_orderkey, l_linenumber
  FROM lineitem),
daily AS (
  SELECT ticker, CAST(ts AS DATE) AS date,
         arg_min(price, (ts, l_orderkey, l_linenumber, price)) AS open,
         max(price) AS high, min(price) AS low,
         arg_max(price, (ts, l_orderkey, l_linenumber, price)) AS close,
         CAST(sum(volume) AS BIGINT) AS volume
  FROM ticks GROUP BY 1, 2)"""
READINGS_SQL = """
readings AS (
  SELECT ts AS event_time, event_type AS device_id, round(value * 100) AS value FROM events)"""
INTRADAY_SQL = """
intraday AS (
  SELECT 'U' || user_id AS ticker, ts, value AS price,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS volume, event_id AS seq
  FROM events)"""
CLICKS_SQL = """
clicks AS (
  SELECT ts AS click_time, 'U' || user_id AS user_id, '/p/' || json_extract_string(props, '$.k') AS page_url
  FROM events)"""
POSTS_SQL = r"""
posts AS (
  SELECT doc_id, split_part(text, chr(10), 1) AS title,
         substring(text, length(split_part(text, chr(10), 1)) + 2) AS content, source, lang
  FROM documents),
lexicon AS (
  SELECT token, length(token) % 9 - 4 AS valence
  FROM (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}'']+')) AS token FROM benchmark))"""
