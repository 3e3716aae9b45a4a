"""Sources, sinks and whole jobs."""

import json
from datetime import datetime, timedelta

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from tickstone import schemas, sinks
from tickstone.operators import market
from tickstone.plans import jobs
from tickstone.sources import TopicSpec, or_fallback, read_table, read_topic
from tickstone.streaming import await_any, foreach_batch, newest_records, read_table_sink, start, update_sink

BASE = datetime(2024, 1, 1, 12)


def envelope(spark, records, topic="t", start=0):
    """``records`` are dicts or raw text, one per second."""
    data = [
        (b"k", (r if isinstance(r, str) else json.dumps(r)).encode(), topic, 0, start + i, BASE + timedelta(seconds=start + i))
        for i, r in enumerate(records)
    ]
    return spark.createDataFrame(data, schemas.ENVELOPE)


def test_bounded_topic(spark, tmp_path):
    path = f"{tmp_path}/topic"
    envelope(spark, [{"id": str(i)} for i in range(5)]).write.parquet(path)
    envelope(spark, [{"id": "other"}], topic="u").write.mode("append").parquet(path)
    spec = TopicSpec("t", path=path)
    got = read_topic(spark, spec, schemas.ID_MESSAGE, start=BASE + timedelta(seconds=1), end=BASE + timedelta(seconds=3))
    assert rows(got, "id") == [("1",), ("2",)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(timestamp" in plan and "EqualTo(topic,t)" in plan


def test_fallbacks(spark, tmp_path):
    empty = spark.createDataFrame([], "a int")
    full = spark.createDataFrame([(1,)], "a int")
    full.write.parquet(f"{tmp_path}/f")
    assert or_fallback(full, "a int").count() == 1
    assert or_fallback(empty, "a int", f"{tmp_path}/f").count() == 1
    assert or_fallback(empty, "a int").count() == 0
    assert read_table(spark, default_path=f"{tmp_path}/f", column="a", start=2).count() == 0
    with pytest.raises(ValueError):
        read_table(spark)
    with pytest.raises(ValueError):
        read_table(spark, jdbc={"url": "x", "partitionColumn": "a"})


def test_save_formats(spark, tmp_path):
    df = spark.range(20).selectExpr("id", "concat('n', id) as name")
    for fmt in ("parquet", "CSV", "json"):
        path = sinks.save(df, f"{tmp_path}/{fmt}", fmt)
        back = spark.read.option("header", True).format(fmt.lower()).load(path)
        assert back.count() == 20 and set(back.columns) == {"id", "name"}
    with pytest.raises(ValueError):
        sinks.save(df, f"{tmp_path}/x", "xml")


def test_jdbc_round_trip(spark, tmp_path):
    options = {"url": f"jdbc:derby:{tmp_path}/db;create=true", "dbtable": "prices", "driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    df = spark.createDataFrame([("A", BASE, 10.126, 5), ("B", BASE, 1.0, 6)], "ticker string, timestamp timestamp, price double, volume bigint")
    sinks.write_jdbc(df, options, "overwrite", schemas.STOCK_PRICES)
    sinks.write_jdbc(df.limit(1), options, "append", schemas.STOCK_PRICES)
    parallel = {**options, "partitionColumn": "VOLUME", "lowerBound": "0", "upperBound": "10", "numPartitions": "2"}
    back = read_table(spark, jdbc=parallel)
    assert back.count() == 3 and str(back.where("volume = 5 AND price > 2").first().price) == "10.13"
    assert back.rdd.getNumPartitions() == 2
    with pytest.raises(ValueError):
        sinks.write_jdbc(df, options, "upsert")


def test_append_rows_casts(spark, tmp_path):
    df = spark.createDataFrame([("A", "price_drop", BASE, "{}")], "ticker string, event_type string, timestamp timestamp, data string")
    for _ in range(2):
        sinks.append_rows(df.withColumn("extra", F.lit(1)), f"{tmp_path}/e", schemas.EVENTS)
    assert spark.read.parquet(f"{tmp_path}/e").count() == 2


def test_replayed_batch_counts_once_and_uncommitted_is_hidden(spark, tmp_path):
    path = str(tmp_path)
    one, two = spark.range(3), spark.range(10, 12)
    for _ in range(2):
        sinks.write_replay_safe({"orders": one, "payments": one}, path, 0)
    two.write.parquet(f"{path}/orders/batch_id=1")  # written, then the job died before the commit
    assert sinks.read_committed(spark, path, "orders").count() == 3
    sinks.write_replay_safe({"orders": two, "payments": two}, path, 1)
    assert sinks.read_committed(spark, path, "orders").count() == 5
    assert sinks.read_committed(spark, path, "payments").count() == 5


def test_upsert_versions(spark, tmp_path):
    from tickstone.sinks.replay import latest_version, read_version

    path = str(tmp_path)
    first = spark.createDataFrame([("a", 1), ("b", 2)], "k string, cnt bigint")
    second = spark.createDataFrame([("b", 9), ("c", 3)], "k string, cnt bigint")
    sinks.upsert_counts(first, path, 0, ["k"])
    for _ in range(2):
        sinks.upsert_counts(second, path, 1, ["k"])
    assert rows(read_version(spark, path, "counts", latest_version(spark, path))) == [("a", 1), ("b", 9), ("c", 3)]


def test_finding_the_newest_manifest_takes_two_folders(spark, tmp_path):
    from tickstone.sinks.replay import Manifest, newest_manifest

    known = Manifest()
    for batch in range(1000):
        known = known.with_batch(batch, {})
    assert known.ranges == [(0, 999)] and known.with_batch(1005, {}).ranges == [(0, 999), (1005, 1005)]
    path, files = str(tmp_path), set()
    for batch in (0, 1, 2, 5, 6):
        sinks.write_replay_safe({"t": spark.range(batch + 1)}, path, batch, keep=2)
        files.add(len(list(tmp_path.glob("manifest/*/*.parquet"))))
    assert files == {1, 2} and newest_manifest(spark, path).ranges == [(0, 2), (5, 6)]
    assert sorted(p.name for p in tmp_path.glob("t/*")) == ["batch_id=5", "batch_id=6"]  # older ones are gone


def test_a_crash_while_the_manifest_is_written_hides_only_that_batch(spark, tmp_path):
    import shutil

    path = str(tmp_path)
    for batch in (0, 1):
        sinks.write_replay_safe({"t": spark.range(1)}, path, batch)
    newest = max(tmp_path.glob("manifest/slot=*"), key=lambda p: spark.read.parquet(str(p)).first().version)
    shutil.rmtree(newest)
    newest.mkdir()
    assert sinks.read_committed(spark, path, "t").count() == 1
    sinks.write_replay_safe({"t": spark.range(1)}, path, 1)
    assert sinks.read_committed(spark, path, "t").count() == 2


def test_only_touched_days_are_rewritten(spark, tmp_path):
    from tickstone.sinks.replay import latest_version, read_version

    path = str(tmp_path)
    counts = lambda data: spark.createDataFrame([(at(t), "a", n) for t, n in data], "bucket timestamp_ntz, action string, cnt bigint")
    upsert = lambda batch, data: sinks.upsert_counts(counts(data), path, batch, ["bucket", "action"], part=F.to_date("bucket"))
    upsert(0, [(f"2024-01-0{d} 10:00", d) for d in (1, 2, 3)])
    for _ in range(2):
        upsert(1, [("2024-01-02 10:00", 20), ("2024-01-02 11:00", 21)])
    assert sorted(p.name for p in tmp_path.glob("counts/batch_id=1/part=*")) == ["part=2024-01-02"]
    upsert(2, [("2024-01-02 10:00", 200), ("2024-01-09 00:00", 9)])
    assert sorted(p.name for p in tmp_path.glob("counts/batch_id=2/part=*")) == ["part=2024-01-02", "part=2024-01-09"]
    assert not list(tmp_path.glob("counts/batch_id=0/part=2024-01-02"))  # replaced twice
    newest = rows(read_version(spark, path, "counts", latest_version(spark, path)), "bucket", "cnt")
    want = [("2024-01-01 10:00", 1), ("2024-01-02 10:00", 200), ("2024-01-02 11:00", 21), ("2024-01-03 10:00", 3), ("2024-01-09 00:00", 9)]
    assert newest == sorted(((at(t), n) for t, n in want), key=repr)
    assert read_version(spark, path, "counts", 1).count() == 4


def test_updates_of_a_topic_repeat_without_harm(spark, tmp_path):
    sink = update_sink(["k"], "parquet", {"path": f"{tmp_path}/topic"})
    first, second = (spark.createDataFrame(d, "k string, n bigint") for d in ([("a", 1), ("b", 1)], [("a", 5)]))
    for batch, batch_id in ((first, 0), (second, 1), (second, 1), (first, 0)):
        sink(batch, batch_id)
    assert rows(newest_records(spark.read.parquet(f"{tmp_path}/topic"), "k STRING, n BIGINT")) == [("a", 5), ("b", 1)]


def tick(i, ticker="A", close=10.0, **more):
    day = (datetime(2024, 1, 1, 9) + timedelta(days=i)).strftime("%Y-%m-%d %H:%M:%S")
    return {"ticker": ticker, "timestamp": day, "open": close, "high": close, "low": close, "close": close, "volume": 10, **more}


def test_market_job_from_topic_to_outputs(spark, tmp_path):
    path = f"{tmp_path}/topic"
    envelope(spark, [tick(i, close=10.0 + i) for i in range(30)] + [tick(i, "B") for i in range(5)]).write.parquet(path)
    ticks = jobs.load_ticks(spark, TopicSpec("t", path=path), start_day="2024-01-01", end_day="2024-01-20")
    assert ticks.count() == 25
    summary = jobs.market_job(ticks, tickers="A,B")
    assert rows(summary, "ticker", "close") == [("A", 29.0), ("B", 10.0)]
    out, topic = f"{tmp_path}/out", f"{tmp_path}/published"
    url = {"url": f"jdbc:derby:{tmp_path}/db;create=true", "dbtable": "results", "driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    jobs.publish_market(summary, out, "json", ("parquet", {"path": topic}), url)
    documents = spark.read.json(out)
    assert rows(documents, "ticker", "ma_status") == [("A", "bullish"), ("B", "neutral")]
    assert documents.schema["signals"].dataType.typeName() == "array"
    assert json.loads(spark.read.parquet(topic).where("key = 'A'").first().value)["close"] == 29.0
    assert read_table(spark, jdbc=url).count() == 2
    report_rows, alert_lines = jobs.market_report(summary, "2024-01-20")
    assert report_rows.count() == 2 and alert_lines.where("ticker = 'A'").count() >= 1
    with pytest.raises(ValueError):
        jobs.market_job(ticks, tickers="none")


def test_ticks_of_one_time_and_a_topic_without_records(spark, tmp_path):
    path, prices = f"{tmp_path}/topic", f"{tmp_path}/prices"
    envelope(spark, [tick(0, close=c) for c in (10.0, 12.0, 11.0)]).repartition(3).write.parquet(path)
    ticks = jobs.load_ticks(spark, TopicSpec("t", path=path))
    assert rows(ticks, "seq", "close") == [(0, 10.0), (1, 12.0), (2, 11.0)]
    assert rows(jobs.market_job(ticks), "ticker", "open", "close") == [("A", 10.0, 11.0)]
    stored = [("B", datetime(2024, 1, 1), datetime(2024, 1, 1).date(), 1.0, 1.0, 1.0, 1.0, 5)]
    spark.createDataFrame(stored, schemas.PRICE_ROW).write.parquet(prices)
    assert rows(jobs.load_ticks(spark, TopicSpec("none", path=path), path=prices), "ticker") == [("B",)]
    assert rows(jobs.load_ticks(spark, TopicSpec("t", path=path), path=prices), "ticker") == [("A",)] * 3
    assert jobs.load_ticks(spark, TopicSpec("none", path=path)).isEmpty()


def test_landing_and_minute_counts(spark, tmp_path):
    path = f"{tmp_path}/topic"
    records = [{"user_id": i, "event": "login", "timestamp": f"2024-01-01T10:00:0{i}"} for i in range(3)] + ["{bad"]
    envelope(spark, records).write.parquet(path)
    url = {"url": f"jdbc:derby:{tmp_path}/db;create=true", "dbtable": "landed", "driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    for _ in range(2):
        jobs.landing_job(spark, TopicSpec("t", path=path, fail_on_data_loss=False), url)
    landed = read_table(spark, jdbc=url)
    assert landed.count() == 4
    counted = jobs.count_minutes(landed.toDF(*[c.lower() for c in landed.columns]))
    assert rows(counted, "event", "cnt") == [("login", 3)]


def stream(spark, tmp_path, records):
    path = f"{tmp_path}/in"
    envelope(spark, records).coalesce(1).write.mode("append").parquet(path)
    return read_topic(spark, TopicSpec("t", path=path), streaming=True, max_per_trigger=10)


def finish(queries):
    try:
        for q in queries:
            q.processAllAvailable()
    finally:
        for q in queries:
            q.stop()


def test_device_job(spark, tmp_path):
    values = [(i, 400.0 if i == 31 else 50.0 + i % 3) for i in range(60)] + [(300, 50.0)]
    records = [
        {"timestamp": (BASE + timedelta(seconds=s)).isoformat(), "value": v, "device_id": "d1", "status": "Normal"}
        for s, v in values
    ]
    root, seen = f"{tmp_path}/root", spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    source = stream(spark, tmp_path, records)
    read = source.mapInArrow(count, source.schema)
    finish(jobs.device_job(read, root, ("parquet", {"path": f"{root}/alerts"})))
    assert seen.value == len(records)  # each record is read and parsed once, for all outputs
    assert rows(read_table_sink(spark, f"{root}/device_status", "device_status")) == [("d1", "Normal", 61)]
    assert rows(read_table_sink(spark, f"{root}/status_counts", "status_counts")) == [("Normal", 61)]
    assert spark.read.parquet(f"{root}/anomalies").where("is_anomaly").count() == 3
    alerts = spark.read.parquet(f"{root}/alerts")
    assert alerts.count() == 3 and json.loads(alerts.first().value)["anomaly_type"] == "HIGH_VALUE"
    assert spark.read.parquet(f"{root}/readings").count() == 61
    assert not spark.read.parquet(f"{root}/averages").isEmpty()


def test_click_job(spark, tmp_path):
    records = [
        {"user_id": "bot", "page_url": f"/p{i}", "click_time": (BASE + timedelta(seconds=i)).isoformat() + "Z"} for i in range(8)
    ] + [{"user_id": "u", "page_url": "/p1", "click_time": BASE.isoformat() + "Z"}]
    root = f"{tmp_path}/root"
    finish(jobs.click_job(stream(spark, tmp_path, records), root))
    assert read_table_sink(spark, f"{root}/top_pages", "top_pages").count() == 5
    assert read_table_sink(spark, f"{root}/top_users", "top_users").count() == 3
    found = sinks.read_committed(spark, f"{root}/found", "suspicious")
    assert {json.loads(r.value)["user_id"] for r in found.collect()} == {"bot"}
    assert "window_start" in json.loads(found.first().value)


def test_feed_and_notify_jobs(spark, tmp_path):
    price = [
        {"ticker": "A", "price": p, "volume": 10, "timestamp": (BASE + timedelta(seconds=i)).isoformat(), "data_type": "stock_price"}
        for i, p in enumerate([100.0, 110.0, 100.0])
    ]
    news = [
        {"ticker": "A", "title": "good good", "source": "news", "timestamp": BASE.isoformat(), "data_type": "news"},
        {"ticker": "B", "title": "meh", "content": "x", "source": "reddit", "published_at": BASE.isoformat(), "data_type": "reddit"},
        {"data_type": "other"}, "{bad", {"ticker": "C", "price": None, "volume": 1, "data_type": "stock_price"},
    ]
    lexicon = spark.createDataFrame([("good", 2.0)], "token string, valence double")
    root = f"{tmp_path}/root"
    finish(jobs.feed_job(stream(spark, tmp_path, price + news), lexicon, root))
    events = sinks.read_committed(spark, f"{root}/prices", "events")
    assert rows(events, "ticker", "event_type") == [("A", "price_drop"), ("A", "price_surge")] or rows(
        events, "ticker", "event_type"
    ) == [("A", "price_surge")]
    results = sinks.read_committed(spark, f"{root}/news", "results")
    assert rows(results, "ticker", "sentiment_label") == [("A", "positive"), ("B", "neutral")]
    assert sinks.read_committed(spark, f"{root}/news", "alerts").count() == 1

    assert rows(spark.read.parquet(f"{root}/stock_prices"), "ticker", "price") == [("A", 100.0), ("A", 100.0), ("A", 110.0)]
    rejected = [r.value for r in spark.read.parquet(f"{root}/rejected").collect()]
    assert len(rejected) == 3 and "{bad" in rejected

    again = tmp_path / "notify"
    again.mkdir()
    alerts = [{"type": "price_drop", "message": "m", "severity": "high"}] * 3 + [{"message": "n"}]
    finish(jobs.notify_job(stream(spark, again, alerts), f"{again}/root"))
    sent = spark.read.parquet(f"{again}/root/notifications")
    assert rows(sent, "message", "severity_class") == [("m", "critical"), ("n", "info")]
    assert spark.read.parquet(f"{again}/root/late_alerts").isEmpty() and spark.read.parquet(f"{again}/root/alerts_in_time").count() == 4


def test_price_alert_job(spark, tmp_path):
    ticks = [tick(0), tick(1, close=10.1), tick(2, close=10.9), "{bad", tick(3, close=None), tick(4, "B"), tick(5, "B", 10.5)]
    own = spark.createDataFrame([("B", 6.0)], "ticker string, threshold double")
    finish([jobs.price_alert_job(stream(spark, tmp_path, ticks), own, f"{tmp_path}/root")])
    sent = spark.read.parquet(f"{tmp_path}/root/price_alerts")
    assert rows(sent, "ticker", "close", "previous", "direction") == [("A", 10.9, 10.1, "up")]


def test_a_micro_batch_is_computed_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    source = stream(spark, tmp_path, [{"id": str(i)} for i in range(20)]).select("offset")

    def write(batch, batch_id):
        sinks.write_replay_safe({"one": batch, "two": batch}, f"{tmp_path}/out", batch_id)

    finish([start(source.mapInArrow(count, "offset long"), foreach_batch(write), checkpoint=f"{tmp_path}/checkpoint")])
    assert sinks.read_committed(spark, f"{tmp_path}/out", "two").count() == 20 and seen.value == 20


def test_transform_and_triggers(spark, tmp_path):
    records = [{"pet_name": "Rex", "pet_mood_post_treat": "zoomy", "final_treat": True}, "{bad"]
    source = stream(spark, tmp_path, records)
    calls = []
    finish([
        jobs.transform_topic(source, f"{tmp_path}/a"),
        jobs.triggered(source, lambda batch, _: calls.extend(r.pet_name for r in batch.collect()), f"{tmp_path}/b"),
    ])
    values = [r.value for r in sinks.read_committed(spark, f"{tmp_path}/a", "out").collect()]
    assert len(values) == 2 and "{bad" in values and calls == ["Rex"]
    assert callable(await_any)


def test_memory_and_console_sinks(spark, tmp_path, capfd):
    source = stream(spark, tmp_path, [{"id": "1"}, {"id": "2"}])
    counts = source.groupBy("topic").count()
    finish([start(counts, "memory", "complete", name="counts_table"), start(counts, "console", "update", every="1 second")])
    assert rows(spark.table("counts_table")) == [("t", 2)]
    with pytest.raises(ValueError):
        read_table_sink(spark, f"{tmp_path}/none", "x")


def test_default_path_is_dated():
    from datetime import date

    from tickstone.sinks.batch import default_path

    assert default_path(date(2024, 3, 1)) == "stock_analysis_results_20240301"
    assert market.MarketConfig().trend == (50, 200)
    assert at("2024-01-01").year == 2024
