from datetime import date, datetime, timedelta

import pytest
from conftest import rows

from tickstone.operators import market, report

DAY0 = date(2024, 1, 1)


def bars(spark, closes, ticker="T"):
    data = [(ticker, DAY0 + timedelta(days=i), c, c, c, c, 10) for i, c in enumerate(map(float, closes))]
    return spark.createDataFrame(
        data, "ticker string, date date, open double, high double, low double, close double, volume bigint"
    )


def column(df, name):
    return [r[name] for r in df.orderBy("ticker", "date").collect()]


def test_daily_bars_order_ties_by_sequence(spark):
    noon = datetime(2024, 1, 1, 12)
    ticks = spark.createDataFrame(
        [("T", noon, 2, 5.0, 7.0, 4.0, 6.0, 10), ("T", noon, 1, 1.0, 2.0, 1.0, 2.0, 5),
         ("T", noon + timedelta(hours=1), 0, 9.0, 9.0, 3.0, 8.0, 1), ("T", noon + timedelta(days=1), 9, 4.0, 4.0, 4.0, 4.0, 2)],
        "ticker string, ts timestamp, seq bigint, open double, high double, low double, close double, volume bigint",
    )
    got = rows(market.daily_ohlcv(ticks, seq="seq"), "date", "open", "high", "low", "close", "volume")
    assert got == [(date(2024, 1, 1), 1.0, 9.0, 1.0, 8.0, 16), (date(2024, 1, 2), 4.0, 4.0, 4.0, 4.0, 2)]


def test_daily_bars_reduce_before_the_shuffle_without_sorting(spark):
    ticks = spark.range(10).selectExpr(
        "'T' as ticker", "timestamp_seconds(id) as ts", "id as seq", "1D as open", "1D as high", "1D as low",
        "1D as close", "1L as volume",
    )
    plan = market.daily_ohlcv(ticks, seq="seq")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "partial_min_by" in plan


def test_single_row(spark):
    only = market.analyse(bars(spark, [7])).first()
    assert (only.ma_5, only.ma_200, only.macd, only.macd_signal) == (7.0, 7.0, 0.0, 0.0)
    assert only.rsi is None and only.golden_cross == only.death_cross == 0 and only.change_pct == 0.0


def test_short_frames_and_min_periods(spark):
    df = bars(spark, [1, 2, 3])
    assert column(market.moving_averages(df, [2]), "ma_2") == [1.0, 1.5, 2.5]
    assert column(market.moving_averages(df, [2], min_periods=2), "ma_2") == [None, 1.5, 2.5]


def test_rsi_extremes(spark):
    rising, falling = bars(spark, [1, 2, 3]), bars(spark, [3, 2, 1])
    assert column(market.rsi(rising), "rsi") == [None, None, None]
    assert column(market.rsi(rising, no_loss=100.0), "rsi") == [100.0, 100.0, 100.0]
    assert column(market.rsi(falling), "rsi") == [None, 0.0, 0.0]
    last = market.summarize(market.analyse(falling)).first()
    assert last.rsi == 0.0 and last.rsi_status == "unknown"


def test_cross_needs_a_change_of_order(spark):
    cfg = market.MarketConfig(short=1, long=2)
    df = market.macd(market.rsi(market.moving_averages(bars(spark, [5, 5, 8, 9, 2]), [1, 2])))
    crossed = market.crossovers(df, cfg)
    assert column(crossed, "golden_cross") == [0, 0, 1, 0, 0]
    assert column(crossed, "death_cross") == [0, 0, 0, 0, 1]


@pytest.mark.parametrize(
    ("flags", "want"),
    [
        ({"golden_cross": 1, "rsi_oversold": 1}, ("golden_cross", None, "strong")),
        ({"golden_cross": 1, "rsi_overbought": 1}, ("golden_cross", "rsi_overbought", "strong")),
        ({"rsi_overbought": 1, "macd_bullish_cross": 1}, ("macd_bullish", "rsi_overbought", "medium")),
        ({"macd_bearish_cross": 1}, (None, "macd_bearish", "weak")),
        ({}, (None, None, None)),
    ],
)
def test_signals(spark, flags, want):
    names = ["golden_cross", "death_cross", "rsi_overbought", "rsi_oversold", "macd_bullish_cross", "macd_bearish_cross"]
    df = spark.createDataFrame([tuple(flags.get(n, 0) for n in names)], names)
    got = market.trading_signals(df).first()
    assert (got.buy_signal, got.sell_signal, got.signal_strength) == want


def test_ema_macd_starts_at_the_first_close(spark):
    got = market.macd(bars(spark, [10, 20]), fast=1, slow=3, signal=1, kind="ema")
    assert column(got, "macd") == pytest.approx([0.0, 5.0])
    with pytest.raises(ValueError):
        market.macd(bars(spark, [1]), kind="other")


def test_pct_change_after_zero(spark):
    assert column(market.pct_change(bars(spark, [10, 15, 0, 3])), "change_pct") == [0.0, 50.0, -100.0, 0.0]


def test_summary_keeps_one_window_exchange(spark):
    summary = market.summarize(market.analyse(bars(spark, [1, 2])))
    plan = summary._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_documents_and_report(spark):
    summary = market.summarize(market.analyse(bars(spark, [1, 2, 3])))
    forced = summary.selectExpr(
        "* except (buy_signal, sell_signal, signal_strength, rsi, rsi_status, ma_status)",
        "'golden_cross' as buy_signal", "'rsi_overbought' as sell_signal", "'strong' as signal_strength",
        "72.26D as rsi", "'overbought' as rsi_status", "'bearish' as ma_status",
    )
    document = report.ticker_documents(forced).first()
    assert document.date == "2024-01-03" and document.change_pct == pytest.approx(50.0)
    assert [(s.type, s.direction, s.strength) for s in document.signals] == [
        ("golden_cross", "buy", "strong"), ("rsi_overbought", "sell", "strong")
    ]
    alerts = [r.alert for r in report.report_alerts(report.ticker_documents(forced)).orderBy("position").collect()]
    assert alerts == [
        "T: golden_cross 신호 감지 - golden_cross 매수 신호 감지",
        "T: rsi_overbought 신호 감지 - rsi_overbought 매도 신호 감지",
        "T: RSI 과매수 상태 (RSI: 72.3) - 매도 고려",
        "T: 약세 추세 - 단기 이동평균선이 장기 이동평균선 아래에 위치",
    ]
    row = report.report_rows(report.ticker_documents(forced), "2024-01-03").first()
    assert (row.report_date, row.change_mark, row.rsi_mark, row.ma_mark) == (date(2024, 1, 5), "🚀", "⚠️", "📉")
