"""Time windows: panes against plain windows, anomaly rules, late rows."""

import random
import time
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tickstone.operators import aggregates, parse, topk, windows
from tickstone.plans import streams
from tickstone.streaming import start

BASE = datetime(2024, 1, 1)


def readings(spark, values, kind="timestamp"):
    data = [(BASE + timedelta(seconds=s), d, None if v is None else float(v)) for s, d, v in values]
    return spark.createDataFrame(data, f"event_time {kind}, device_id string, value double")


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_panes_equal_plain_windows(spark, kind):
    rng = random.Random(1)
    data = [(rng.randint(0, 300), rng.choice("aab"), None if i % 9 == 0 else 1e6 + rng.random()) for i in range(400)]
    df = readings(spark, data, kind)
    got = windows.window_stats(df, "event_time", ["device_id"], "value", "30 seconds", "10 seconds")
    plain = df.groupBy(F.window("event_time", "30 seconds", "10 seconds").alias("window"), "device_id").agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("a"), F.stddev("value").alias("s"),
        F.max("value").alias("hi"), F.min("value").alias("lo"),
    )
    both = got.join(plain, ["window", "device_id"])
    assert got.schema["window"].dataType["start"].dataType.typeName() == kind
    assert both.count() == plain.count() == got.count()
    close = "count = n AND avg_value <=> a AND max_value <=> hi AND min_value <=> lo"
    for r in both.selectExpr(f"{close.replace('avg_value <=> a', 'true')} as same", "avg_value", "a", "stddev_value", "s").collect():
        assert r.same and r.avg_value == pytest.approx(r.a, rel=1e-12)
        assert r.stddev_value == (None if r.s is None else pytest.approx(r.s, rel=1e-6, abs=1e-9))


def test_distinct_panes_equal_plain_windows(spark):
    rng = random.Random(4)
    data = [(BASE + timedelta(seconds=rng.randint(0, 200)), rng.choice("ab"), rng.choice("uvwxyz")) for _ in range(200)]
    df = spark.createDataFrame(data, "ts timestamp, user_id string, page_url string")
    got = aggregates.distinct_per_window(df, "ts", "user_id", "page_url", "30 seconds", "10 seconds")
    plain = df.groupBy(F.window("ts", "30 seconds", "10 seconds").alias("window"), "user_id")
    assert rows(got) == rows(plain.agg(F.count_distinct("page_url")))


def detect(spark, values, **kw):
    return windows.detect_anomalies(readings(spark, [(i, "d", v) for i, v in enumerate(values)]), size="10 seconds", slide=None, **kw).first()


def test_anomaly_rules(spark):
    one = detect(spark, [5])
    assert (one.stddev_value, one.z_score_max, one.anomaly_type, one.anomaly_score) == (0.001, 0.0, "NORMAL", 0.0)
    assert detect(spark, [3, 3, 3]).anomaly_type == "NORMAL"
    assert detect(spark, [1, 1, 1, 1, 1e9]).anomaly_type == "NORMAL"  # five rows cannot reach two sigma
    high, low = detect(spark, [1, 1, 1, 1, 1, 1e9]), detect(spark, [1, 1, 1, 1, 1, -1e9])
    assert high.anomaly_type == "HIGH_VALUE" and high.anomaly_score == pytest.approx(high.z_score_max)
    assert low.anomaly_type == "LOW_VALUE" and low.anomaly_score == pytest.approx(-low.z_score_min)


def test_planted_anomalies_become_alerts(spark):
    rng = random.Random(7)
    data = [(i, "d", rng.gauss(50, 5)) for i in range(60)] + [(31, "d", 400)]
    raised = windows.anomaly_alerts(windows.detect_anomalies(readings(spark, data)))
    starts = [r.window_start for r in raised.where("max_value = 400").collect()]
    assert sorted(starts) == [BASE + timedelta(seconds=s) for s in (10, 20, 30)]


def test_top_k(spark):
    data = [(BASE + timedelta(seconds=s), p) for s, p in [(1, "a"), (2, "a"), (3, "b"), (4, "c"), (61, "z")]]
    df = spark.createDataFrame(data, "ts timestamp, page string")
    assert rows(topk.top_global(df, "ts", "page", 2, "1 minute", None), "page") == [("a",), ("z",)]
    best = topk.top_per_window(df, "ts", "page", 2, "1 minute", None)
    assert rows(best, "page", "rank") == [("a", 1), ("b", 2), ("z", 1)]


def feed(spark, path, batches):
    for batch in batches:
        readings(spark, batch).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.02)
    stream = spark.readStream.schema("event_time timestamp, device_id string, value double")
    return stream.option("maxFilesPerTrigger", 1).parquet(path)


def run(df, mode, root):
    spark, kept = df.sparkSession, {}

    def sink(batch, batch_id):
        for r in parse.flatten_window(batch).collect():
            kept[r.window_start[-8:], r.device_id] = r["count"]
        if mode == "complete":
            assert batch.count() == len(kept)

    start(df, sink, mode, f"{root}/ck", available_now=True).awaitTermination()
    return kept


def counts(stream):
    return windows.window_stats(stream, "event_time", ["device_id"], "value", "10 seconds", stats=("count",), watermark="30 seconds")


# A far too late row right after the watermark moved still counts; one batch later it is dropped.
LATE = [[(5, "d", 1), (100, "d", 1)], [(105, "d", 1)], [(6, "d", 1), (200, "d", 1)]]


def test_late_rows_by_output_mode(spark, tmp_path):
    append = run(counts(feed(spark, f"{tmp_path}/a", LATE)), "append", f"{tmp_path}/1")
    update = run(counts(feed(spark, f"{tmp_path}/b", LATE)), "update", f"{tmp_path}/2")
    complete = run(counts(feed(spark, f"{tmp_path}/c", LATE)), "complete", f"{tmp_path}/3")
    first, open_window = ("00:00:00", "d"), ("00:03:20", "d")
    assert append[first] == 1 and open_window not in append
    assert update[first] == 1 and update[open_window] == 1
    assert complete[first] == 2 and complete["00:01:40", "d"] == 2


def test_exact_suspicious_users_on_a_stream(spark, tmp_path):
    data = [(BASE + timedelta(seconds=i), "bad", f"/p{i % 6}") for i in range(12)]
    data += [(BASE + timedelta(seconds=i), "good", "/p1") for i in range(12)]
    data += [(BASE + timedelta(seconds=500), "good", "/p1")]
    schema = "ts timestamp, user_id string, page_url string"
    df = spark.createDataFrame(data, schema)
    df.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
    found = parse.flatten_window(aggregates.suspicious_users(stream, "ts"))
    query = start(found, "parquet", "append", f"{tmp_path}/ck", options={"path": f"{tmp_path}/out"}, available_now=True)
    query.awaitTermination()
    got = spark.read.schema(found.schema).parquet(f"{tmp_path}/out")
    want = parse.flatten_window(aggregates.suspicious_users(df, "ts"))
    assert rows(got) == rows(want) and {r.user_id for r in want.collect()} == {"bad"}


def test_start_checks_its_arguments(spark, tmp_path):
    stream = feed(spark, f"{tmp_path}/x", [[(1, "d", 1)]])
    with pytest.raises(ValueError):
        start(stream, "parquet", "append")
    with pytest.raises(ValueError):
        start(stream, "memory", "sometimes")


def test_micro_batches_of_several_files_stay_in_order(spark, tmp_path):
    rng = random.Random(5)
    # a third of the rows at one time, so that a batch is uneven
    data = [(i, BASE + timedelta(seconds=5000 if i % 3 == 0 else rng.randrange(10_000)), i % 7, "view", float(i), '{"k": 1}') for i in range(1200)]
    data += [(2000, BASE + timedelta(seconds=9_990), 1, "view", 1.0, None)]
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/events.parquet")
    seen = {}

    def sink(batch, batch_id):
        row = batch.agg(F.min("ts"), F.max("ts"), F.count("*"), F.countDistinct("file")).first()
        seen[batch_id] = tuple(row)

    events = streams._events_in_batches(spark, str(tmp_path), rows_a_file=10).withColumn("file", F.input_file_name())
    start(events, sink, "append", f"{tmp_path}/ck", available_now=True).awaitTermination()
    parts = [seen[i] for i in sorted(seen)]
    assert len(parts) == 4 and sum(p[2] for p in parts) == 1201
    assert all(a[1] < b[0] for a, b in zip(parts, parts[1:], strict=False))
    assert max(p[3] for p in parts) > 10  # many files, which many tasks read


def test_suspicious_candidates_have_all_suspicious_users(spark):
    rng = random.Random(7)
    data = [(BASE + timedelta(seconds=rng.randrange(60)), f"u{u}", None if rng.random() < 0.1 else f"/p/{rng.randrange(n)}") for u, n in enumerate((2, 4, 5, 6, 30, 300, 3000)) for _ in range(40 * n if n < 300 else 900)]
    df = spark.createDataFrame(data, "event_timestamp timestamp, user_id string, page_url string")
    for least in (1, 5, 20, 250):
        exact = aggregates.suspicious_users(df, min_pages=least, watermark=None)
        named = aggregates.suspicious_candidates(df, min_pages=least, watermark=None)
        assert exact.join(named, ["window", "user_id"], "left_anti").isEmpty()
        assert rows(aggregates.suspicious_exactly(df, named, min_pages=least)) == rows(exact)
    one = df.where("user_id = 'u0'")  # two pages, opened often
    assert aggregates.suspicious_candidates(one, min_pages=20, watermark=None).isEmpty()
    assert "hyperloglog" not in aggregates.suspicious_candidates(df)._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "approx_count" not in aggregates.suspicious_candidates(df)._jdf.queryExecution().optimizedPlan().toString()
