"""Streaming queries: the files of a table are streamed through, and the sink's content returned.

Where the SQL is that of a batch query, the stream must end with the batch result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickstone.operators import aggregates, alerts, parse, topk, windows
from tickstone.plans.inputs import CLICKS_SQL, EVENT_RECORD, cents_of, clicks, envelope, payload_number, table
from tickstone.plans.registry import REGISTRY, query
from tickstone.plans.rules import EVENTS, SEEDED_EVENTS_SQL, purchase_averages, shown_price_alerts
from tickstone.plans.scratch import work_dir
from tickstone.plans.timewindows import CLICK_WINDOWS
from tickstone.sources import stream_files
from tickstone.streaming import (
    dedup_alerts_stream,
    market_events_stream,
    newest_records,
    price_alerts_stream,
    start,
    update_sink,
)


def _events(spark, sf_dir) -> DataFrame:
    """Events as a stream.  Watermarks need TIMESTAMP, which equals the stored time in UTC."""
    path = f"{sf_dir}/events.parquet"
    events = stream_files(spark, path, spark.read.parquet(path).schema)
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


ROWS_A_FILE = 200_000


def _events_in_batches(spark, sf_dir, batches: int = 4, rows_a_file: int = ROWS_A_FILE) -> DataFrame:
    """The events as a stream of several micro-batches, oldest first.

    Each micro-batch has the same number of files, so that large ones are written and read by many tasks.  Empty partitions leave
    no file; an uneven batch is filled up with empty files.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    path = work_dir(spark, "batches")
    at = F.unix_micros("ts")
    quantiles = F.percentile_approx(at, [i / batches for i in range(1, batches)])
    edges, n = events.agg(quantiles, F.count("*")).first()
    files = max(1, n // (batches * rows_a_file))
    for i, (low, high) in enumerate(zip([None, *edges], [*edges, None], strict=True)):
        own = (F.lit(True) if low is None else at > low) & (F.lit(True) if high is None else at <= high)
        rows = events.where(own)
        rows = rows.coalesce(1) if files == 1 else rows.repartition(files)
        rows.write.mode("append").parquet(path)
        for _ in range(len(spark.read.schema(events.schema).parquet(path).inputFiles()), files * (i + 1)):
            events.limit(0).coalesce(1).write.mode("append").parquet(path)
    return stream_files(spark, path, events.schema, max_files=files)


def _readings(spark, sf_dir, events=None) -> DataFrame:
    return (events or _events)(spark, sf_dir).select(
        F.col("ts").alias("event_time"),
        F.col("event_type").alias("device_id"),
        cents_of("value").alias("value"),
    )


def _clicks(spark, sf_dir, events=None) -> DataFrame:
    return (events or _events)(spark, sf_dir).select(
        F.col("ts").alias("click_time"),
        F.concat(F.lit("U"), "user_id").alias("user_id"),
        F.concat(F.lit("/p/"), payload_number()).alias("page_url"),
    )


def _drain(df: DataFrame, mode: str, label: str) -> DataFrame:
    """Run the stream until its input is used up and return what the sink holds.

    Complete mode hands over the whole result each time, so it replaces the last one; the other
    modes add files.
    """
    spark = df.sparkSession
    root = work_dir(spark, label)
    out = f"{root}/out"
    if mode == "complete":

        def sink(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(out)

        running = start(df, sink, mode, f"{root}/checkpoint", available_now=True)
    else:
        running = start(df, "parquet", mode, f"{root}/checkpoint", options={"path": out}, available_now=True)
    running.awaitTermination()
    result = spark.read.schema(df.schema).parquet(out)
    plain = {
        f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema.fields if f.dataType.typeName() == "timestamp"
    }
    return result.withColumns(plain) if plain else result


def _flat(df: DataFrame) -> DataFrame:
    flat = parse.flatten_window(df, iso=False) if "window" in df.columns else df
    return flat.withColumn("stddev_value", F.round("stddev_value", 4)) if "stddev_value" in flat.columns else flat


@query("stream_parse", REGISTRY["parse_json"].sql)
def stream_parse(spark, sf_dir):
    parsed = parse.parse_topic(envelope(_events(spark, sf_dir)), EVENT_RECORD)
    rows = parsed.select("key", F.col("event_id").cast("double"), "event_type", "value", "event_time")
    return _drain(rows, "append", "parse")


@query("stream_count_by_status", REGISTRY["count_by_status"].sql)
def stream_count_by_status(spark, sf_dir):
    events = _events(spark, sf_dir).withColumnRenamed("event_type", "status")
    return _drain(aggregates.count_by(events, ["status"]), "complete", "status")


@query("stream_tumbling", REGISTRY["tumbling"].sql)
def stream_tumbling(spark, sf_dir):
    stats = windows.tumbling(
        _readings(spark, sf_dir), "event_time", ["device_id"], "value", "1 hour", watermark="1 minute"
    )
    return _drain(_flat(stats), "complete", "tumbling")


@query("stream_sliding", REGISTRY["sliding"].sql)
def stream_sliding(spark, sf_dir):
    stats = windows.sliding(
        _readings(spark, sf_dir), "event_time", ["device_id"], "value", "1 day", "6 hours", watermark="1 minute"
    )
    return _drain(_flat(stats), "complete", "sliding")


@query("stream_hourly", REGISTRY["hourly"].sql)
def stream_hourly(spark, sf_dir):
    counts = windows.hourly(_readings(spark, sf_dir), "event_time", "device_id", "1 minute")
    return _drain(_flat(counts), "complete", "hourly")


@query("stream_anomalies", REGISTRY["anomalies"].sql)
def stream_anomalies(spark, sf_dir):
    found = windows.detect_anomalies(_readings(spark, sf_dir), size="1 day", slide="6 hours", sigma=6.0)
    scores = ["z_score_max", "z_score_min", "anomaly_score"]
    return _drain(_flat(found).withColumns({c: F.round(c, 6) for c in scores}), "complete", "anomalies")


@query("stream_top_pages_global", REGISTRY["top_pages_global"].sql)
def stream_top_pages_global(spark, sf_dir):
    top = topk.top_global(_clicks(spark, sf_dir), "click_time", "page_url", 5, "1 day", "6 hours")
    return _drain(_flat(top), "complete", "top-pages")


# Append mode emits a window once the watermark has passed its end.
@query(
    "stream_suspicious_users",
    f"""
    WITH {CLICKS_SQL}, {CLICK_WINDOWS}
    SELECT window_start, window_end, user_id, count(DISTINCT page_url) AS distinct_page_count
    FROM spread WHERE window_end <= (SELECT max(click_time) - INTERVAL 30 SECOND FROM clicks)
    GROUP BY ALL HAVING count(DISTINCT page_url) >= 5
    """,
)
def stream_suspicious_users(spark, sf_dir):
    found = aggregates.suspicious_users(_clicks(spark, sf_dir), "click_time", size="1 day", slide="6 hours")
    return _drain(_flat(found), "append", "suspicious")


@query("stream_suspicious_users_all", REGISTRY["suspicious_users"].sql)
def stream_suspicious_users_all(spark, sf_dir):
    """All windows, the newest too: candidates of a sketch in update mode, counted exactly from the stored clicks."""
    size = {"size": "1 day", "slide": "6 hours"}
    found = aggregates.suspicious_candidates(_clicks(spark, sf_dir, _events_in_batches), "click_time", **size)
    root = work_dir(spark, "candidates")

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/out/batch_id={batch_id}")

    start(found, sink, "update", f"{root}/checkpoint", available_now=True).awaitTermination()
    candidates = spark.read.schema(found.schema).parquet(f"{root}/out")
    stored = clicks(spark, sf_dir).withColumn("click_time", F.col("click_time").cast("timestamp"))
    users = _flat(aggregates.suspicious_exactly(stored, candidates, "click_time", **size))
    return users.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@query("stream_sliding_updates", REGISTRY["sliding"].sql)
def stream_sliding_updates(spark, sf_dir):
    """Update mode into a topic with nested window keys, of which the newest records are read."""
    stats = windows.sliding(
        _readings(spark, sf_dir, _events_in_batches), "event_time", ["device_id"], "value", "1 day", "6 hours", watermark="1 minute"
    )
    root = work_dir(spark, "updates")
    sink = update_sink(["window", "device_id"], "parquet", {"path": f"{root}/topic"})
    start(stats, sink, "update", f"{root}/checkpoint", available_now=True).awaitTermination()
    schema = "window STRUCT<start: TIMESTAMP, end: TIMESTAMP>, device_id STRING, avg_value DOUBLE, stddev_value DOUBLE"
    newest = _flat(newest_records(spark.read.parquet(f"{root}/topic"), schema))
    return newest.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@query("stream_seeded_market_events", SEEDED_EVENTS_SQL)
def stream_seeded_market_events(spark, sf_dir):
    """Stored averages set the first baselines of a stream of several micro-batches."""
    ticks = _events_in_batches(spark, sf_dir).select(
        F.concat(F.lit("U"), "user_id").alias("ticker"),
        "ts",
        F.col("value").alias("price"),
        payload_number().alias("volume"),
        F.col("event_id").alias("seq"),
    )
    history = purchase_averages(spark, sf_dir)
    found = market_events_stream(ticks, EVENTS, history=history, history_path=work_dir(spark, "history")).drop("previous")
    return _drain(found.withColumn("change_pct", F.round("change_pct", 6)), "append", "seeded")


@query("stream_market_events", REGISTRY["market_events"].sql)
def stream_market_events(spark, sf_dir):
    ticks = _events(spark, sf_dir).select(
        F.concat(F.lit("U"), "user_id").alias("ticker"),
        "ts",
        F.col("value").alias("price"),
        payload_number().alias("volume"),
        F.col("event_id").alias("seq"),
    )
    found = market_events_stream(ticks, EVENTS).drop("previous")
    return _drain(found.withColumn("change_pct", F.round("change_pct", 6)), "append", "events")


@query("stream_price_alerts", REGISTRY["price_alerts"].sql)
def stream_price_alerts(spark, sf_dir):
    sent = F.when(F.col("event_id") % 4 == 0, payload_number().cast("double") - 50).otherwise(0.0)
    ticks = _events(spark, sf_dir).select(
        "user_id", "ts", "event_id", F.col("value").alias("close"), sent.alias("change_pct")
    )
    own = table(spark, sf_dir, "customer").where("c_acctbal > 3000")
    own = own.select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").cast("double").alias("threshold"))
    found = price_alerts_stream(ticks, own, key="user_id", tie="event_id")
    return _drain(shown_price_alerts(found), "append", "price-alerts")


@query("stream_dedup_alerts", REGISTRY["dedup_alerts"].sql)
def stream_dedup_alerts(spark, sf_dir):
    raised = _events(spark, sf_dir).select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("type"),
        F.lit("m").alias("message"),
        F.col("ts").alias("timestamp"),
    )
    return _drain(dedup_alerts_stream(raised, 7200, watermark="1 minute").drop("message"), "append", "dedup-alerts")


@query("stream_dedup_messages", REGISTRY["dedup_messages"].sql)
def stream_dedup_messages(spark, sf_dir):
    copies = F.explode(F.sequence(F.lit(0), F.col("event_id") % 3)).alias("attempt")
    sent = _events(spark, sf_dir).select(F.col("event_id").alias("id"), "event_type", "value", "ts", copies)
    unique = alerts.dedup_messages(sent.drop("attempt"), "id", ("ts", "10 minutes"))
    return _drain(unique.drop("ts"), "append", "dedup-messages")
