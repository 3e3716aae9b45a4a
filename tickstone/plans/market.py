"""Market queries: from ticks to the daily report."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickstone.operators import market, report
from tickstone.plans.inputs import TICKS_SQL, daily_ticks, text_date
from tickstone.plans.registry import query

RUN_DATE = "2001-08-01"


def _rows(n: int) -> str:
    return f"(PARTITION BY ticker ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


W = "(PARTITION BY ticker ORDER BY date)"

INDICATORS_SQL = f"""{TICKS_SQL},
moved AS (
  SELECT *, coalesce(close - lag(close) OVER {W}, 0) AS change, lag(close) OVER {W} AS prev_close FROM daily),
averaged AS (
  SELECT *, avg(close) OVER {_rows(5)} AS ma_5, avg(close) OVER {_rows(20)} AS ma_20,
         avg(close) OVER {_rows(50)} AS ma_50, avg(close) OVER {_rows(200)} AS ma_200,
         avg(greatest(change, 0)) OVER {_rows(14)} AS gain, avg(greatest(-change, 0)) OVER {_rows(14)} AS loss,
         avg(close) OVER {_rows(12)} - avg(close) OVER {_rows(26)} AS macd,
         max(high) OVER {_rows(10)} AS high_10d, min(low) OVER {_rows(10)} AS low_10d,
         coalesce((close - prev_close) / nullif(prev_close, 0) * 100, 0) AS change_pct
  FROM moved),
rated AS (
  SELECT *, 100 - 100 / (1 + gain / nullif(loss, 0)) AS rsi, avg(macd) OVER {_rows(9)} AS macd_signal FROM averaged),
flagged AS (
  SELECT *, macd - macd_signal AS macd_histogram,
    CASE WHEN ma_5 > ma_20 AND lag(ma_5) OVER {W} <= lag(ma_20) OVER {W} THEN 1 ELSE 0 END AS golden_cross,
    CASE WHEN ma_5 < ma_20 AND lag(ma_5) OVER {W} >= lag(ma_20) OVER {W} THEN 1 ELSE 0 END AS death_cross,
    CASE WHEN rsi > 70 THEN 1 ELSE 0 END AS rsi_overbought, CASE WHEN rsi < 30 THEN 1 ELSE 0 END AS rsi_oversold,
    CASE WHEN macd > macd_signal AND lag(macd) OVER {W} <= lag(macd_signal) OVER {W} THEN 1 ELSE 0 END
      AS macd_bullish_cross,
    CASE WHEN macd < macd_signal AND lag(macd) OVER {W} >= lag(macd_signal) OVER {W} THEN 1 ELSE 0 END
      AS macd_bearish_cross,
    CASE WHEN close > ma_50 AND ma_50 > ma_200 THEN 'bullish' WHEN close < ma_50 AND ma_50 < ma_200 THEN 'bearish'
         ELSE 'neutral' END AS trend
  FROM rated),
signalled AS (
  SELECT *,
    CASE WHEN golden_cross = 1 THEN 'golden_cross' WHEN rsi_oversold = 1 THEN 'rsi_oversold'
         WHEN macd_bullish_cross = 1 THEN 'macd_bullish' END AS buy_signal,
    CASE WHEN death_cross = 1 THEN 'death_cross' WHEN rsi_overbought = 1 THEN 'rsi_overbought'
         WHEN macd_bearish_cross = 1 THEN 'macd_bearish' END AS sell_signal,
    CASE WHEN golden_cross + death_cross > 0 AND rsi_oversold + rsi_overbought > 0 THEN 'strong'
         WHEN golden_cross + death_cross + rsi_oversold + rsi_overbought > 0 THEN 'medium'
         WHEN macd_bullish_cross + macd_bearish_cross > 0 THEN 'weak' END AS signal_strength
  FROM flagged),
summary AS (
  SELECT *, (ma_50 / ma_200 - 1.0) * 100 AS ma_50_200_diff_pct,
    CASE WHEN rsi IS NULL OR rsi = 0 THEN 'unknown' WHEN rsi > 70 THEN 'overbought' WHEN rsi < 30 THEN 'oversold'
         ELSE 'neutral' END AS rsi_status,
    CASE WHEN close > ma_5 AND ma_5 > ma_20 THEN 'bullish' WHEN close < ma_5 AND ma_5 < ma_20 THEN 'bearish'
         ELSE 'neutral' END AS ma_status
  FROM signalled QUALIFY date = max(date) OVER (PARTITION BY ticker))
"""


def _daily(spark, sf_dir):
    return market.daily_ohlcv(daily_ticks(spark, sf_dir), seq="seq")


def _analysed(spark, sf_dir):
    return market.analyse(_daily(spark, sf_dir))


def _summary(spark, sf_dir):
    return market.summarize(_analysed(spark, sf_dir))


@query(
    "daily_ohlcv",
    f"WITH {TICKS_SQL} SELECT ticker, CAST(date AS VARCHAR) AS date, open, high, low, close, volume FROM daily",
)
def daily_ohlcv(spark, sf_dir):
    return _daily(spark, sf_dir).select("ticker", text_date(), "open", "high", "low", "close", "volume")


@query(
    "moving_averages",
    f"""
    WITH {TICKS_SQL}
    SELECT ticker, CAST(date AS VARCHAR) AS date, avg(close) OVER {_rows(5)} AS ma_5, avg(close) OVER {_rows(10)}
             AS ma_10, avg(close) OVER {_rows(20)} AS ma_20, avg(close) OVER {_rows(50)} AS ma_50,
           avg(close) OVER {_rows(200)} AS ma_200
    FROM daily
    """,
)
def moving_averages(spark, sf_dir):
    averaged = market.moving_averages(_daily(spark, sf_dir))
    return averaged.select("ticker", text_date(), "ma_5", "ma_10", "ma_20", "ma_50", "ma_200")


@query(
    "pct_change",
    f"""
    WITH {INDICATORS_SQL}
    SELECT ticker, CAST(date AS VARCHAR) AS date, close, round(change_pct, 6) AS change_pct FROM averaged
    """,
)
def pct_change(spark, sf_dir):
    changed = market.pct_change(_daily(spark, sf_dir))
    return changed.select("ticker", text_date(), "close", F.round("change_pct", 6).alias("change_pct"))


@query(
    "rsi",
    f"WITH {INDICATORS_SQL} SELECT ticker, CAST(date AS VARCHAR) AS date, round(rsi, 6) AS rsi FROM rated",
)
def rsi(spark, sf_dir):
    return market.rsi(_daily(spark, sf_dir)).select("ticker", text_date(), F.round("rsi", 6).alias("rsi"))


_MACD = ["macd", "macd_signal", "macd_histogram"]


@query(
    "macd",
    f"""
    WITH {INDICATORS_SQL}
    SELECT ticker, CAST(date AS VARCHAR) AS date, round(macd, 4) AS macd, round(macd_signal, 4) AS macd_signal,
           round(macd_histogram, 4) AS macd_histogram
    FROM flagged
    """,
)
def macd(spark, sf_dir):
    lined = market.macd(_daily(spark, sf_dir))
    return lined.select("ticker", text_date(), *[F.round(c, 4).alias(c) for c in _MACD])


@query(
    "macd_ema",
    f"""
    WITH RECURSIVE {TICKS_SQL},
    ranked AS (SELECT ticker, date, close, row_number() OVER {W} AS rn FROM daily),
    folded AS (
      SELECT ticker, date, rn, close AS fast, close AS slow, CAST(0 AS DOUBLE) AS signal FROM ranked WHERE rn = 1
      UNION ALL
      SELECT r.ticker, r.date, r.rn, f.fast * (1 - 2.0 / 13) + r.close * (2.0 / 13),
             f.slow * (1 - 2.0 / 27) + r.close * (2.0 / 27),
             f.signal * (1 - 2.0 / 10) + (f.fast * (1 - 2.0 / 13) + r.close * (2.0 / 13)
               - f.slow * (1 - 2.0 / 27) - r.close * (2.0 / 27)) * (2.0 / 10)
      FROM folded f JOIN ranked r ON r.ticker = f.ticker AND r.rn = f.rn + 1)
    SELECT ticker, CAST(date AS VARCHAR) AS date, round(fast - slow, 4) AS macd, round(signal, 4) AS macd_signal,
           round(fast - slow - signal, 4) AS macd_histogram
    FROM folded
    """,
)
def macd_ema(spark, sf_dir):
    lined = market.macd(_daily(spark, sf_dir), kind="ema")
    return lined.select("ticker", text_date(), *[F.round(c, 4).alias(c) for c in _MACD])


_FLAGS = [
    "golden_cross",
    "death_cross",
    "rsi_overbought",
    "rsi_oversold",
    "macd_bullish_cross",
    "macd_bearish_cross",
]


@query(
    "crossovers",
    f"WITH {INDICATORS_SQL} SELECT ticker, CAST(date AS VARCHAR) AS date, {', '.join(_FLAGS)} FROM flagged",
)
def crossovers(spark, sf_dir):
    averaged = market.moving_averages(_daily(spark, sf_dir), [5, 20])
    flagged = market.crossovers(market.macd(market.rsi(averaged)))
    return flagged.select("ticker", text_date(), *_FLAGS)


@query(
    "price_patterns",
    f"WITH {INDICATORS_SQL} SELECT ticker, CAST(date AS VARCHAR) AS date, high_10d, low_10d, trend FROM flagged",
)
def price_patterns(spark, sf_dir):
    averaged = market.moving_averages(_daily(spark, sf_dir), [50, 200])
    return market.price_patterns(averaged).select("ticker", text_date(), "high_10d", "low_10d", "trend")


@query(
    "trading_signals",
    f"""
    WITH {INDICATORS_SQL}
    SELECT ticker, CAST(date AS VARCHAR) AS date, buy_signal, sell_signal, signal_strength FROM signalled
    """,
)
def trading_signals(spark, sf_dir):
    return _analysed(spark, sf_dir).select("ticker", text_date(), "buy_signal", "sell_signal", "signal_strength")


_EXACT = ["open", "high", "low", "close", "volume"]
_ROUNDED = ["ma_short", "ma_long", "ma_50", "ma_200", "rsi", *_MACD, "change_pct"]
_TEXTS = ["trend", "buy_signal", "sell_signal", "signal_strength", "rsi_status", "ma_status"]


@query(
    "market_summary",
    f"""
    WITH {INDICATORS_SQL}
    SELECT ticker, CAST(date AS VARCHAR) AS date, {", ".join(_EXACT)}, round(ma_5, 4) AS ma_short,
           round(ma_20, 4) AS ma_long, {", ".join(f"round({c}, 4) AS {c}" for c in _ROUNDED[2:])},
           round(ma_50_200_diff_pct, 4) AS ma_50_200_diff_pct, {", ".join(_TEXTS)}
    FROM summary
    """,
)
def market_summary(spark, sf_dir):
    rounded = [F.round(c, 4).alias(c) for c in [*_ROUNDED, "ma_50_200_diff_pct"]]
    return _summary(spark, sf_dir).select("ticker", text_date(), *_EXACT, *rounded, *_TEXTS)


@query(
    "ticker_documents",
    f"""
    WITH {INDICATORS_SQL}
    SELECT ticker, CAST(date AS VARCHAR) AS date, close, volume, round(coalesce(rsi, 0), 4) AS rsi,
           round(ma_5, 4) AS ma_short, trend, ma_status, rsi_status,
           CAST((buy_signal IS NOT NULL)::INT + (sell_signal IS NOT NULL)::INT AS BIGINT) AS signal_count,
           coalesce(buy_signal || ' 매수 신호 감지', sell_signal || ' 매도 신호 감지') AS first_signal
    FROM summary
    """,
)
def ticker_documents(spark, sf_dir):
    documents = report.ticker_documents(_summary(spark, sf_dir))
    return documents.select(
        "ticker",
        "date",
        "close",
        "volume",
        F.round("rsi", 4).alias("rsi"),
        F.round("ma_short", 4).alias("ma_short"),
        "trend",
        "ma_status",
        "rsi_status",
        F.size("signals").cast("bigint").alias("signal_count"),
        F.get("signals", F.lit(0))["description"].alias("first_signal"),
    )


@query(
    "report_rows",
    f"""
    WITH {INDICATORS_SQL}
    SELECT '2001-08-03' AS report_date, ticker, open, close, high, low, round(change_pct, 4) AS change_pct,
           round(coalesce(rsi, 0), 4) AS rsi, rsi_status, ma_status,
           CASE WHEN change_pct > 0 THEN '🚀' WHEN change_pct < 0 THEN '📉' ELSE '➖' END AS change_mark,
           CASE rsi_status WHEN 'overbought' THEN '⚠️' WHEN 'oversold' THEN '✅' ELSE '➖' END AS rsi_mark,
           CASE ma_status WHEN 'bullish' THEN '📈' WHEN 'bearish' THEN '📉' ELSE '➖' END AS ma_mark
    FROM summary
    """,
)
def report_rows(spark, sf_dir):
    rows = report.report_rows(report.ticker_documents(_summary(spark, sf_dir)), RUN_DATE)
    return rows.withColumns(
        {
            "report_date": F.col("report_date").cast("string"),
            "change_pct": F.round("change_pct", 4),
            "rsi": F.round("rsi", 4),
        }
    )


@query(
    "report_alerts",
    f"""
    WITH {INDICATORS_SQL},
    lines AS (
      SELECT ticker, 1 AS part, ticker || ': ' || buy_signal || ' 신호 감지 - ' || buy_signal || ' 매수 신호 감지' AS alert
      FROM summary WHERE signal_strength = 'strong' AND buy_signal IS NOT NULL
      UNION ALL
      SELECT ticker, 2, ticker || ': ' || sell_signal || ' 신호 감지 - ' || sell_signal || ' 매도 신호 감지'
      FROM summary WHERE signal_strength = 'strong' AND sell_signal IS NOT NULL
      UNION ALL
      SELECT ticker, 3, CASE rsi_status
        WHEN 'overbought' THEN printf('%s: RSI 과매수 상태 (RSI: %.1f) - 매도 고려', ticker, rsi)
        ELSE printf('%s: RSI 과매도 상태 (RSI: %.1f) - 매수 고려', ticker, rsi) END
      FROM summary WHERE rsi_status IN ('overbought', 'oversold')
      UNION ALL
      SELECT ticker, 4, CASE ma_status
        WHEN 'bullish' THEN ticker || ': 강세 추세 - 단기 이동평균선이 장기 이동평균선 위에 위치'
        ELSE ticker || ': 약세 추세 - 단기 이동평균선이 장기 이동평균선 아래에 위치' END
      FROM summary WHERE ma_status IN ('bullish', 'bearish'))
    SELECT ticker, row_number() OVER (PARTITION BY ticker ORDER BY part) - 1 AS position, alert FROM lines
    """,
)
def report_alerts(spark, sf_dir):
    lines = report.report_alerts(report.ticker_documents(_summary(spark, sf_dir)))
    return lines.withColumn("position", F.col("position").cast("bigint"))
