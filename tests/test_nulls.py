"""Rows with NULLs in the rules, and settings other than the defaults."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tickstone.functions.scalars import render_details
from tickstone.operators import alerts, market

BASE = datetime(2024, 1, 1)


def test_a_tick_without_a_price_raises_nothing(spark):
    prices = [10.0, 10.0, None, 10.0, 10.0, 20.0]
    rows = [("T", BASE + timedelta(seconds=i), i, p, 5) for i, p in enumerate(prices)]
    ticks = spark.createDataFrame(rows, "ticker string, ts timestamp, seq bigint, price double, volume bigint")
    assert [(r.seq, r.event_type) for r in alerts.market_events(ticks).collect()] == [(5, "price_surge")]


def test_alerts_without_a_type_are_kept(spark):
    rows = [(i, BASE + timedelta(seconds=s), t, m) for i, (s, t, m) in enumerate([(0, None, "x"), (5, None, "x"), (6, "a", None), (7, None, None), (400, None, "x")])]
    sent = alerts.dedup_alerts(spark.createDataFrame(rows, "id bigint, timestamp timestamp, type string, message string"))
    assert sorted(r.id for r in sent.collect()) == [0, 2, 3, 4]


def test_a_null_detail_is_shown(spark):
    df = spark.createDataFrame([('{"a":1,"b":null,"c":3}',)], "x string")
    assert df.select(render_details("x")).first()[0] == "a: 1, b: None, c: 3"


def test_summary_with_other_trend_lengths(spark):
    bars = spark.range(40).select(
        F.lit("A").alias("ticker"), F.expr("date_add(date'2024-01-01', cast(id as int))").alias("date"),
        *[(F.col("id") + 1.0).alias(c) for c in ("open", "high", "low", "close")], F.lit(1).alias("volume"))
    cfg = market.MarketConfig(trend=(10, 25))
    last = market.summarize(market.analyse(bars, cfg), cfg).first()
    assert last.ma_10 == 35.5 and last.ma_25 == 28.0 and last.ma_10_25_diff_pct > 0
