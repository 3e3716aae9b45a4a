"""Complete jobs: source, operators and sinks wired together.

Each takes its sources and targets as arguments; nothing here is specific to a cluster.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickstone import schemas
from tickstone.operators import aggregates, alerts, filters, market, parse, report, sentiment, topk, windows
from tickstone.sinks import save, write_jdbc, write_replay_safe, write_topic
from tickstone.sinks.replay import make_folder
from tickstone.sources import TopicSpec, read_table, read_topic
from tickstone.streaming import (
    dedup_alerts_stream,
    foreach_batch,
    late_split,
    market_events_stream,
    price_alerts_stream,
    start,
    table_sink,
)


def load_ticks(
    spark: SparkSession,
    topic: TopicSpec | None = None,
    path: str | None = None,
    jdbc: dict | None = None,
    start_day: date | None = None,
    end_day: date | None = None,
) -> DataFrame:
    """Price ticks from a topic, else from JDBC or parquet, for whole days.

    With both, the stored table takes the place of a topic without records.  Ticks of a topic carry ``seq``, their
    place in it, which orders ticks of one time.
    """
    records = read_topic(spark, topic) if topic is not None else None
    stored = path is not None or jdbc is not None
    if records is not None and not (stored and records.isEmpty()):
        parsed = parse.parse_topic(records, schemas.PRICE_TICK, keep=("key", "partition", "offset"))
        seq = F.shiftleft(F.col("partition").cast("long"), 48) + F.col("offset")
        ticks = parse.with_event_time(parsed.withColumn("seq", seq).drop("partition", "offset"), "timestamp", "ts")
    else:
        ticks = read_table(spark, path=path, jdbc=jdbc).withColumn("ts", F.col("timestamp").cast("timestamp"))
    return filters.in_days(ticks, "ts", start_day, end_day)


def market_job(
    ticks: DataFrame,
    cfg: market.MarketConfig = market.MarketConfig(),
    tickers: Sequence[str] | str = (),
    seq: str | None = None,
) -> DataFrame:
    """Summary of every (chosen) ticker: daily bars, indicators, signals, latest row.

    ``seq`` orders ticks of one time; it defaults to the column of that name, if there is one.
    """
    seq = seq or ("seq" if "seq" in ticks.columns else None)
    chosen = filters.require_rows(filters.in_keys(ticks, "ticker", tickers), "ticks")
    return market.summarize(market.analyse(market.daily_ohlcv(chosen, seq=seq), cfg), cfg)


def publish_market(
    summary: DataFrame,
    path: str,
    fmt: str = "json",
    topic: tuple[str, dict] | None = None,
    jdbc: dict | None = None,
) -> None:
    """Write a summary to files and, if given, to a topic (format, options) and a JDBC table.

    The summary has one row per ticker.  It is read back from the first output where several follow,
    so the analysis runs once.
    """
    if topic or jdbc:
        staged = f"{path}.summary"
        summary.write.mode("overwrite").parquet(staged)
        summary = summary.sparkSession.read.parquet(staged)
    save(summary, path, fmt, documents=fmt == "json")
    if topic:
        write_topic(summary, "ticker", *topic)
    if jdbc:
        results = summary.withColumn("signal", F.col("macd_signal"))
        write_jdbc(results, jdbc, "append", schemas.STOCK_ANALYSIS_RESULTS)


def market_report(summary: DataFrame, run_date: date | str) -> tuple[DataFrame, DataFrame]:
    """(report rows, alert lines) of a summary."""
    documents = report.ticker_documents(summary)
    return report.report_rows(documents, run_date), report.report_alerts(documents)


def landing_job(spark: SparkSession, topic: TopicSpec, jdbc: dict, schema: str = schemas.USER_EVENT) -> None:
    """Land a bounded topic of user events in a JDBC table, replacing its rows."""
    events = parse.with_event_time(read_topic(spark, topic, schema))
    write_jdbc(events.drop("key", "timestamp"), jdbc, "overwrite")


def count_minutes(events: DataFrame, anchor: datetime | None = None) -> DataFrame:
    """Per-minute counts by event over the last day, for :func:`tickstone.sinks.upsert_counts`."""
    return aggregates.minute_counts(events, "event_time", "event", anchor)


def device_readings(records: DataFrame) -> DataFrame:
    """Parsed device readings with event and processing time."""
    parsed = parse.with_event_time(parse.parse_topic(records, schemas.DEVICE_READING, keep=()))
    return parse.with_processing_time(parsed.drop("timestamp"))


def device_job(records: DataFrame, root: str, alert_topic: tuple[str, dict]) -> list[StreamingQuery]:
    """Status counts, window statistics and anomaly alerts of one stream of device records.

    ``root`` holds the checkpoints and outputs; ``alert_topic`` is (format, options).  The topic is read and parsed once, into
    ``root``/readings; the other queries read what they need of these rows.  Outputs that share a window and a key come from one
    aggregate.  The counts are tables replaced as a whole; windows are written once they are final, so that their state
    stays bounded.
    """
    spark = records.sparkSession
    parsed = device_readings(records)
    make_folder(spark, f"{root}/readings")
    readings = spark.readStream.schema(parsed.schema).parquet(f"{root}/readings")
    keys = ["device_id"]
    stats = windows.window_stats(readings, "event_time", keys, "value", "30 seconds", "10 seconds", watermark="1 minute")
    tumbling = windows.tumbling(readings, "event_time", keys, "value", watermark="1 minute")
    averages = windows.sliding(
        readings, "event_time", keys, "value", "10 seconds", "5 seconds", ("avg", "count"), "10 seconds"
    )
    fmt, options = alert_topic

    def write_stats(batch: DataFrame, batch_id: int) -> None:
        anomalies = windows.score_windows(batch)
        raised = parse.with_processing_time(windows.anomaly_alerts(anomalies), "alert_time")
        sliding = batch.select("window", "device_id", "avg_value", "stddev_value")
        for name, rows in {"sliding": sliding, "anomalies": anomalies}.items():
            rows.write.mode("overwrite").parquet(f"{root}/{name}/batch_id={batch_id}")
        write_topic(raised, "device_id", fmt, options)

    def write_counts(batch: DataFrame, batch_id: int) -> None:
        by_status = batch.groupBy("status").agg(F.sum("count").alias("count"))
        by_device = batch.orderBy("device_id", F.desc("count"), "status")
        tables = {"device_status": by_device, "status_counts": by_status.orderBy(F.desc("count"), "status")}
        for name, rows in tables.items():
            write_replay_safe({name: rows}, f"{root}/{name}", batch_id, keep=2)

    counts = aggregates.count_by(readings, ["device_id", "status"], ordered=False)
    each = lambda df, write, mode, name: start(df, foreach_batch(write, flat=False), mode, f"{root}/checkpoint/{name}", name)
    return [
        _to_files(parsed, root, "readings"),
        each(counts, write_counts, "complete", "status"),
        each(stats, write_stats, "append", "windows"),
        _to_files(windows.hourly(readings, "event_time", "status", "1 minute"), root, "hourly"),
        _to_files(averages, root, "averages"),
        _to_files(tumbling, root, "tumbling"),
    ]


def _to_files(df: DataFrame, root: str, name: str) -> StreamingQuery:
    options = {"path": f"{root}/{name}"}
    return start(df, "parquet", "append", f"{root}/checkpoint/{name}", name, options)


def _to_table(df: DataFrame, root: str, name: str) -> StreamingQuery:
    """Complete results as a table, read with ``read_table_sink(spark, f"{root}/{name}", name)``."""
    return start(df, table_sink(f"{root}/{name}", name), "complete", f"{root}/checkpoint/{name}", name)


def click_job(records: DataFrame, root: str) -> list[StreamingQuery]:
    """Top pages, top users and suspicious users of a click stream.

    Suspicious users go, micro-batch by micro-batch, to ``root``/found.
    """
    parsed = parse.parse_topic(records, schemas.CLICK, keep=())
    clicks = parse.with_event_time(parsed, "click_time", "event_timestamp")
    found = aggregates.suspicious_users(clicks, approx=True)

    def emit(batch: DataFrame, batch_id: int) -> None:
        write_replay_safe({"suspicious": parse.to_topic(batch, "user_id")}, f"{root}/found", batch_id)

    return [
        _to_table(topk.top_global(clicks, "event_timestamp", "page_url", 5), root, "top_pages"),
        _to_table(topk.top_global(clicks, "event_timestamp", "user_id", 3), root, "top_users"),
        start(found, foreach_batch(emit), "update", f"{root}/checkpoint/suspicious", "suspicious"),
    ]


def feed_job(
    records: DataFrame,
    lexicon: DataFrame,
    root: str,
    cfg: alerts.EventConfig = alerts.EventConfig(),
    history: DataFrame | None = None,
) -> list[StreamingQuery]:
    """Price events and news sentiment of a mixed feed.

    Prices go through keyed state; news are scored per micro-batch.  Both write their rows and
    their alerts together under ``root``/prices and ``root``/news.  The prices themselves go to ``root``/stock_prices,
    whose latest rows can be the ``history`` of a later run.  Records of an unknown kind, malformed ones and prices
    without time, price or volume go to ``root``/rejected as they came.
    """
    kind = F.get_json_object(F.col("value").cast("string"), "$.data_type").alias("data_type")
    routed = parse.split_routes(records.select("*", kind))

    parsed = parse.parse_topic(routed["stock"], schemas.RAW_STOCK, keep=("offset", "value"))
    parsed = parse.with_event_time(parsed, "timestamp", "ts")
    usable = F.expr("ts IS NOT NULL AND price IS NOT NULL AND volume IS NOT NULL")
    prices = parsed.where(usable).drop("value")
    stored = prices.select("ticker", F.col("ts").alias("timestamp"), "price", "volume")
    unknown = parse.decode_envelope(routed["unknown"]).select("value")
    rejected = parsed.where(~usable).select("value").unionByName(unknown)
    events = market_events_stream(prices, cfg, tie="offset", history=history, history_path=f"{root}/history")

    def write_prices(batch: DataFrame, batch_id: int) -> None:
        rows = {"events": alerts.event_data(batch), "alerts": alerts.market_event_alerts(batch)}
        write_replay_safe(rows, f"{root}/prices", batch_id)

    news = parse.parse_topic(routed["news"], schemas.RAW_NEWS, keep=("topic", "partition", "offset"))

    def write_news(batch: DataFrame, batch_id: int) -> None:
        keyed = batch.withColumn("_id", F.concat_ws("/", "topic", "partition", "offset"))
        filled = parse.fill_missing(keyed, {"content": "", "url": ""})
        published = F.coalesce("published_at", "timestamp")
        dated = filled.withColumn("timestamp", F.try_to_timestamp(published))
        scores = sentiment.sentiment(dated, lexicon, "_id")
        columns = ["ticker", "source", "title", "content", "url", "timestamp"]
        results = sentiment.sentiment_results(dated, scores, "_id", columns).drop("_id")
        rows = {"results": results, "alerts": sentiment.sentiment_alerts(results)}
        write_replay_safe(rows, f"{root}/news", batch_id)

    return [
        start(events, foreach_batch(write_prices), "append", f"{root}/checkpoint/prices", "prices"),
        start(news, foreach_batch(write_news), "append", f"{root}/checkpoint/news", "news"),
        _to_files(stored, root, "stock_prices"),
        _to_files(rejected, root, "rejected"),
    ]


def price_alert_job(records: DataFrame, thresholds: DataFrame, root: str, default: float = 2.0) -> StreamingQuery:
    """Alerts on ticks whose price moved by the ticker's threshold or more, to ``root``/price_alerts."""
    parsed = parse.parse_topic(records, schemas.PRICE_TICK, keep=("offset",))
    ticks = parse.with_event_time(parsed, "timestamp", "ts").where("ts IS NOT NULL AND close IS NOT NULL")
    return _to_files(price_alerts_stream(ticks, thresholds, default, tie="offset"), root, "price_alerts")


def notify_job(records: DataFrame, root: str, seconds: float = 300, late: str = "1 hour") -> list[StreamingQuery]:
    """Alerts without repeats, labelled for delivery, to ``root``/notifications.

    Alerts that come more than ``late`` after newer ones can no longer be compared with those sent; they are kept in
    ``root``/late_alerts, each one that came.
    """
    received = records.withColumnRenamed("timestamp", "_received")
    parsed = parse.parse_topic(received, schemas.ALERT, keep=("offset", "_received"))
    stamp = F.coalesce(F.try_to_timestamp("timestamp"), F.col("_received"))
    timed = parsed.withColumn("timestamp", stamp).drop("_received")
    filled = parse.fill_missing(timed, {"type": report.ALERT_TYPE, "message": report.ALERT_MESSAGE})
    make_folder(records.sparkSession, f"{root}/alerts_in_time")
    split = start(
        filled, late_split(root, "timestamp", late, "alerts_in_time", "late_alerts"), "append", f"{root}/checkpoint/split", "split"
    )
    in_time = records.sparkSession.readStream.schema(filled.schema).option("recursiveFileLookup", "true")
    in_time = in_time.parquet(f"{root}/alerts_in_time")
    unique = dedup_alerts_stream(in_time, seconds, tie="offset", watermark=late)
    return [split, _to_files(report.alert_labels(unique), root, "notifications")]


def triggered(records: DataFrame, call, root: str) -> StreamingQuery:
    """Call ``call(batch, batch_id)`` with the rows of finished series that need attention."""
    parsed = parse.parse_topic(records, schemas.SERIES_MESSAGE)
    return start(filters.trigger_rows(parsed), foreach_batch(call), "append", f"{root}/checkpoint/triggers", "triggers")


def transform_topic(records: DataFrame, root: str) -> StreamingQuery:
    """Read committed input, mark it as processed, and write it exactly once."""
    marked = parse.enrich_or_pass(parse.decode_envelope(records).select("key", "value"))

    def write(batch: DataFrame, batch_id: int) -> None:
        write_replay_safe({"out": batch}, root, batch_id)

    return start(marked, foreach_batch(write), "append", f"{root}/checkpoint/transform", "transform")
