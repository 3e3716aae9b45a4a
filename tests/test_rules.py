"""Price, volume and alert rules: edge cases, a plain loop as reference, and stream = batch."""

import random
import time
from datetime import datetime, timedelta

import pytest
from conftest import at, rows

from tickstone.operators import alerts
from tickstone.streaming import dedup_alerts_stream, late_split, market_events_stream, price_alerts_stream, start

BASE = datetime(2024, 1, 1)
TICK = "ticker string, ts timestamp, seq bigint, price double, volume bigint"


def ticks(spark, steps, ticker="T"):
    """``steps`` are (seconds, price, volume)."""
    data = [(ticker, BASE + timedelta(seconds=s), i, float(p), v) for i, (s, p, v) in enumerate(steps)]
    return spark.createDataFrame(data, TICK)


def found(df):
    return [(r.seq, r.event_type) for r in df.orderBy("seq").collect()]


def by_hand(data, cfg, seeds=None):
    """One message after the other, per ticker in order of time."""
    out, state, last = [], {}, {}
    for ticker, ts, seq, price, volume in sorted(data):
        if ticker not in state:
            state[ticker] = (seeds or {}).get(ticker, (price, volume))
            continue
        b, bv = state[ticker]
        change, vchange = (price - b) / b * 100, (volume - bv) / bv * 100 if bv else 0
        for kind, hit in (
            ("price_surge", change >= cfg.surge), ("price_drop", change <= cfg.drop), ("volume_surge", vchange >= cfg.volume)
        ):
            before = last.get((ticker, kind))
            if hit and (before is None or (ts - before).total_seconds() > cfg.cooldown):
                out.append((ticker, seq, kind))
                last[ticker, kind] = ts
                break
        state[ticker] = (0.7 * b + 0.3 * price, 0.7 * bv + 0.3 * volume)
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def busy():
    rng = random.Random(11)
    out = []
    for i in range(3000):
        ticker = "HOT" if i % 3 else f"C{i % 40}"
        when = BASE + timedelta(seconds=rng.randint(0, 4 * 86_400))
        out.append((ticker, when, i, 100 + rng.gauss(0, 4), rng.randint(0, 100)))
    return out


@pytest.mark.parametrize("parts", [None, 12])
def test_market_events_equal_a_loop(spark, busy, parts):
    cfg = alerts.EventConfig(cooldown=900)
    got = alerts.market_events(spark.createDataFrame(busy, TICK), cfg, parts=parts)
    assert rows(got, "ticker", "seq", "event_type") == by_hand(busy, cfg)


def test_market_events_start_from_history(spark, busy):
    seeds = {"HOT": (50.0, 10.0), "C3": (200.0, 5.0)}
    history = spark.createDataFrame([(k, *v) for k, v in seeds.items()], "ticker string, prev_price double, prev_volume double")
    got = alerts.market_events(spark.createDataFrame(busy, TICK), history=history)
    assert rows(got, "ticker", "seq", "event_type") == by_hand(busy, alerts.EventConfig(), seeds)


def test_first_tick_only_seeds_and_is_not_folded(spark):
    got = alerts.market_events(ticks(spark, [(0, 100, 100), (400, 103, 100)])).first()
    assert (got.seq, got.previous, got.change_pct) == (1, 100.0, 3.0)


def test_cooling_surge_falls_through_to_volume(spark):
    steps = [(0, 100, 100), (10, 110, 100), (20, 130, 300)]
    assert found(alerts.market_events(ticks(spark, steps))) == [(1, "price_surge"), (2, "volume_surge")]


def test_cooldown_limit_is_strict(spark):
    steps = [(0, 100, 100), (10, 110, 100), (310, 140, 100)]
    assert found(alerts.market_events(ticks(spark, steps))) == [(1, "price_surge")]
    later = [*steps[:2], (311, 140, 100)]
    assert found(alerts.market_events(ticks(spark, later))) == [(1, "price_surge"), (2, "price_surge")]


def test_zero_baselines(spark):
    assert found(alerts.market_events(ticks(spark, [(0, 100, 0), (10, 100, 500)]))) == []
    assert found(alerts.market_events(ticks(spark, [(0, 0, 10), (10, 100, 500)]))) == []


def test_thresholds_must_exclude_each_other():
    with pytest.raises(ValueError):
        alerts.EventConfig(surge=1.0, drop=1.0)


def test_event_alerts_and_data(spark):
    events = alerts.market_events(ticks(spark, [(0, 100, 100), (10, 110, 100), (20, 100, 300)]))
    got = {r.type: r for r in alerts.market_event_alerts(events).collect()}
    assert got["price_surge"].message == "T 가격 급등: $100.00 → $110.00 (10.00%)"
    assert got["price_surge"].severity == "high" and got["volume_surge"].severity == "medium"
    assert got["volume_surge"].message == "T 거래량 급증: 100 → 300 (200.00%)"
    data = {r.event_type: r.data for r in alerts.event_data(events).collect()}
    assert '"prev_volume":100.0' in data["volume_surge"] and '"prev_price":100.0' in data["price_surge"]


def price_ticks(spark, steps):
    data = [("T", BASE + timedelta(seconds=i), i, float(c), p) for i, (c, p) in enumerate(steps)]
    return spark.createDataFrame(data, "ticker string, ts timestamp, seq bigint, close double, change_pct double")


def test_price_alert_rules(spark):
    own = spark.createDataFrame([("T", 5.0)], "ticker string, threshold double")
    none = own.limit(0)
    steps = [(100, 9.0), (102, 0.0), (102, 0.0), (103, -6.0), (0, 0.0), (50, 0.0), (52, None)]
    got = rows(alerts.price_alerts(price_ticks(spark, steps), none), "seq", "direction", "threshold")
    # The first never alerts; 0 and missing changes are computed; a previous price of 0 counts as no change.
    assert got == [(1, "up", 2.0), (3, "down", 2.0), (4, "down", 2.0), (6, "up", 2.0)]
    assert rows(alerts.price_alerts(price_ticks(spark, steps), own), "seq") == [(3,), (4,)]
    text = alerts.price_alerts(price_ticks(spark, steps), none).where("seq = 1").first().message
    assert text == "T 주가가 2.0% 이상 상승했습니다: 2.00%"


def test_alert_dedup_compares_with_the_last_sent(spark):
    times = [0, 200, 299, 300, 301]
    data = [("price_drop", "m", BASE + timedelta(seconds=s), s) for s in times] + [("x", "m", BASE, 7)]
    df = spark.createDataFrame(data, "type string, message string, timestamp timestamp, id bigint")
    assert rows(alerts.dedup_alerts(df), "id") == [(0,), (300,), (7,)]


def in_batches(spark, df, order, parts, path):
    """The rows as a stream that delivers them in ``parts`` micro-batches, oldest first."""
    import time

    data = [tuple(r) for r in df.orderBy(order).collect()]
    size = -(-len(data) // parts)
    for i in range(0, len(data), size):
        spark.createDataFrame(data[i : i + size], df.schema).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.02)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def drain(df, root, mode="append"):
    out = f"{root}/out"
    query = start(df, "parquet", mode, f"{root}/ck", options={"path": out}, available_now=True)
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(out)


def test_market_events_stream_equals_batch(spark, busy, tmp_path):
    df = spark.createDataFrame(busy[:900], TICK)
    stream = in_batches(spark, df, "ts", 4, f"{tmp_path}/in")
    got = drain(market_events_stream(stream), tmp_path)
    want = alerts.market_events(df)
    assert rows(got, "ticker", "seq", "event_type") == rows(want, "ticker", "seq", "event_type")
    assert not want.isEmpty()


def test_market_events_stream_seeds_from_history(spark, busy, tmp_path):
    df = spark.createDataFrame(busy[:300], TICK)
    history = spark.createDataFrame([("HOT", 50.0, 10.0)], "ticker string, prev_price double, prev_volume double")
    stream = in_batches(spark, df, "ts", 3, f"{tmp_path}/in")
    found = market_events_stream(stream, history=history, history_path=f"{tmp_path}/history")
    assert "Join" not in found._jdf.queryExecution().analyzed().toString()  # seeds are rows, not a join
    got = drain(found, tmp_path)
    assert rows(got, "ticker", "seq", "event_type") == by_hand(busy[:300], alerts.EventConfig(), {"HOT": (50.0, 10.0)})
    with pytest.raises(ValueError):
        market_events_stream(stream, history=history)


def test_market_events_stream_keeps_keys_together_in_buckets(spark, tmp_path):
    rng = random.Random(3)
    data = [(None if k == 0 else f"K{k}", BASE + timedelta(minutes=10 * s), 40 * s + k, float(rng.randint(90, 110)), rng.randint(1, 9)) for s in range(12) for k in range(40)]
    df = spark.createDataFrame(data, TICK)
    history = spark.createDataFrame([("K1", 50.0, 10.0), ("K99", 1.0, 1.0), (None, 20.0, 5.0)], "ticker string, prev_price double, prev_volume double")
    stream = in_batches(spark, df, "ts", 3, f"{tmp_path}/in")
    found = market_events_stream(stream, history=history, history_path=f"{tmp_path}/history", buckets=4)
    query = start(found, "parquet", "append", f"{tmp_path}/ck", options={"path": f"{tmp_path}/out"}, available_now=True)
    query.awaitTermination()
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 5  # not one for each of 41 keys; NULL has its own
    got = rows(spark.read.schema(found.schema).parquet(f"{tmp_path}/out"), "ticker", "seq", "event_type")
    named = [(k or "", *x) for k, *x in data]
    want = by_hand(named, alerts.EventConfig(), {"K1": (50.0, 10.0), "K99": (1.0, 1.0), "": (20.0, 5.0)})
    assert sorted((k or "", *x) for k, *x in got) == sorted(want) and want


def test_in_time_and_late_rows_are_the_input(spark, tmp_path):
    second = lambda s: BASE + timedelta(seconds=s)
    batches = [[("a", "m", second(0), 0), ("a", "n", second(500), 1)], [("a", "m", second(510), 2)], [("a", "m", second(5), 3), ("a", "x", second(600), 4)],
               [("a", "m", second(700), 5), ("a", "q", second(1), 6), ("a", "m", second(820), 7)]]
    schema = "type string, message string, timestamp timestamp, id bigint"
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        time.sleep(0.05)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    sink = late_split(str(tmp_path), "timestamp", "10 seconds")
    start(stream, sink, "append", f"{tmp_path}/ck1", available_now=True).awaitTermination()
    late = rows(spark.read.schema(schema).parquet(f"{tmp_path}/late"), "id")
    assert late == [(3,), (6,)]
    sink(spark.read.parquet(f"{tmp_path}/in").where("id in (5, 6, 7)"), 3)  # the last micro-batch again
    assert rows(spark.read.schema(schema).parquet(f"{tmp_path}/late"), "id") == late
    staged = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in_time")
    sent = drain(dedup_alerts_stream(staged, 300, watermark="10 seconds"), tmp_path)
    assert rows(sent, "id") == [(0,), (1,), (2,), (4,), (7,)]


def test_price_alerts_stream_equals_batch(spark, tmp_path):
    rng = random.Random(2)
    df = price_ticks(spark, [(100 + rng.gauss(0, 3), rng.choice([0.0, 0.0, 4.0, None])) for _ in range(200)])
    own = spark.createDataFrame([("T", 3.0)], "ticker string, threshold double")
    got = drain(price_alerts_stream(in_batches(spark, df, "ts", 3, f"{tmp_path}/in"), own), tmp_path)
    assert rows(got) == rows(alerts.price_alerts(df, own).select(got.columns))


@pytest.mark.parametrize("watermark", [None, "10 seconds"])
def test_dedup_alerts_stream_equals_batch(spark, tmp_path, watermark):
    rng = random.Random(5)
    pick = lambda: (rng.choice(["a", "b", None]), rng.choice(["m", None]))
    data = [(*pick(), BASE + timedelta(seconds=60 * i + rng.randint(0, 59)), i) for i in range(300)]
    df = spark.createDataFrame(data, "type string, message string, timestamp timestamp, id bigint")
    stream = in_batches(spark, df, "timestamp", 4, f"{tmp_path}/in")
    got = drain(dedup_alerts_stream(stream, 300, watermark=watermark), tmp_path)
    assert rows(got, "id") == rows(alerts.dedup_alerts(df), "id")


def test_state_survives_a_restart(spark, tmp_path):
    first = price_ticks(spark, [(100, 0.0)])
    second = spark.createDataFrame([("T", at("2024-01-02"), 9, 110.0, 0.0)], first.schema)
    none = spark.createDataFrame([], "ticker string, threshold double")
    first.write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(first.schema).parquet(f"{tmp_path}/in")
    assert rows(drain(price_alerts_stream(stream, none), tmp_path)) == []
    second.write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(first.schema).parquet(f"{tmp_path}/in")
    assert rows(drain(price_alerts_stream(stream, none), tmp_path), "seq", "previous") == [(9, 100.0)]
