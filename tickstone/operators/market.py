"""Daily bars, indicators, signals and the latest-row summary.

All indicators use one window, ``partitionBy(key).orderBy(date)``, over daily bars.  A bar is one
row per key and day, so a key's rows are bounded by the days of history, however many ticks it
has; Spark evaluates the whole chain after a single exchange by key.  Frames count rows and are
short at the start of a series: the first row's 200-row average is its own close.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickstone.functions import micros, signed_change
from tickstone.operators.sequence import ewma


@dataclass(frozen=True)
class MarketConfig:
    short: int = 5
    long: int = 20
    rsi: int = 14
    overbought: float = 70.0
    oversold: float = 30.0
    fast: int = 12
    slow: int = 26
    signal: int = 9

    # The two long averages of the trend, and the rows of the high/low pattern.
    trend: tuple[int, int] = (50, 200)
    pattern: int = 10


def _by_date(key: str = "ticker") -> W:
    return W.partitionBy(key).orderBy("date")


def _last(rows: int, key: str = "ticker") -> W:
    return _by_date(key).rowsBetween(1 - rows, 0)


def _position(ts: str, seq: str | None) -> Column:
    """Order of ticks inside a day as one number, so that the daily aggregate stays a hash aggregate.

    A struct of (ts, seq) would order the same but forces Spark to sort all ticks before the
    partial aggregation.  ``seq`` is an integer below 10**25 that breaks ties, such as an offset.
    """
    of_day = F.pmod(micros(ts), F.lit(86_400_000_000))
    if seq is None:
        return of_day
    scaled = of_day.cast("decimal(12,0)") * F.lit("1" + "0" * 25).cast("decimal(26,0)")
    return scaled.cast("decimal(38,0)") + F.col(seq).cast("decimal(25,0)")


def daily_ohlcv(ticks: DataFrame, key: str = "ticker", ts: str = "ts", seq: str | None = None) -> DataFrame:
    """One bar per key and day: first open, highest high, lowest low, last close, summed volume."""
    placed = ticks.withColumns({"date": F.to_date(ts), "_at": _position(ts, seq)})
    return placed.groupBy(key, "date").agg(
        F.min_by("open", "_at").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "_at").alias("close"),
        F.sum("volume").alias("volume"),
    )


def moving_averages(
    df: DataFrame, windows: Sequence[int] = (5, 10, 20, 50, 200), min_periods: int = 1, key: str = "ticker"
) -> DataFrame:
    """Add ``ma_<n>`` per listed length; with ``min_periods`` rows missing the value is NULL."""

    def average(rows: int) -> Column:
        mean = F.avg("close").over(_last(rows, key))
        if min_periods <= 1:
            return mean
        seen = F.count("close").over(_last(rows, key))
        return F.when(seen >= min(rows, min_periods), mean)

    return df.withColumns({f"ma_{n}": average(n) for n in dict.fromkeys(windows)})


def pct_change(df: DataFrame, column: str = "close", name: str = "change_pct", key: str = "ticker") -> DataFrame:
    """Add the percent change against the previous bar; 0 on the first bar and after a 0 value."""
    before = F.lag(column).over(_by_date(key))
    return df.withColumn(name, F.coalesce(signed_change(column, before), F.lit(0.0)))


def rsi(df: DataFrame, n: int = 14, no_loss: float | None = None, key: str = "ticker") -> DataFrame:
    """Add the relative strength index over simple averages of gains and losses.

    Where the frame has no loss the value is ``no_loss``: NULL unless set, 100 by convention.
    """
    change = F.col("close") - F.lag("close").over(_by_date(key))
    moved = df.withColumn("_change", F.coalesce(change, F.lit(0.0)))
    gain = F.avg(F.greatest("_change", F.lit(0.0))).over(_last(n, key))
    loss = F.avg(F.greatest(-F.col("_change"), F.lit(0.0))).over(_last(n, key))
    rated = moved.withColumns({"_gain": gain, "_loss": loss})
    strength = F.col("_gain") / F.nullif(F.col("_loss"), F.lit(0.0))
    index = F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + strength)
    return rated.withColumn("rsi", F.coalesce(index, F.lit(no_loss).cast("double"))).drop(
        "_change", "_gain", "_loss"
    )


def macd(
    df: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9, kind: str = "sma", key: str = "ticker"
) -> DataFrame:
    """Add ``macd``, ``macd_signal`` and ``macd_histogram``.

    ``kind="sma"`` averages simply; ``"ema"`` weights exponentially, each average starting at the
    first value of the series.
    """
    if kind == "sma":
        line = F.avg("close").over(_last(fast, key)) - F.avg("close").over(_last(slow, key))
        lined = df.withColumn("macd", line)
        lined = lined.withColumn("macd_signal", F.avg("macd").over(_last(signal, key)))
    elif kind == "ema":

        def weighted(column: str | tuple[str, str], span: int) -> tuple:
            return column, 1 - 2 / (span + 1), 2 / (span + 1)

        averages = {"_fast": weighted("close", fast), "_slow": weighted("close", slow)}
        averages["macd_signal"] = weighted(("_fast", "_slow"), signal)
        lined = ewma(df, key, "date", [], averages, bounded=True)
        lined = lined.withColumn("macd", F.col("_fast") - F.col("_slow")).drop("_fast", "_slow")
    else:
        raise ValueError("kind must be 'sma' or 'ema'")
    return lined.withColumn("macd_histogram", F.col("macd") - F.col("macd_signal"))


def _flag(condition: Column) -> Column:
    """1 or 0; a NULL condition counts as 0."""
    return F.when(condition, 1).otherwise(0)


def crossovers(df: DataFrame, cfg: MarketConfig = MarketConfig(), key: str = "ticker") -> DataFrame:
    """Add 0/1 flags for average crosses, RSI extremes and MACD crosses against the signal line."""
    order = _by_date(key)

    def crossed(upper: str, lower: str) -> Column:
        before = F.lag(upper).over(order) <= F.lag(lower).over(order)
        return _flag((F.col(upper) > F.col(lower)) & before)

    short, long = f"ma_{cfg.short}", f"ma_{cfg.long}"
    return df.withColumns(
        {
            "golden_cross": crossed(short, long),
            "death_cross": crossed(long, short),
            "rsi_overbought": _flag(F.col("rsi") > cfg.overbought),
            "rsi_oversold": _flag(F.col("rsi") < cfg.oversold),
            "macd_bullish_cross": crossed("macd", "macd_signal"),
            "macd_bearish_cross": crossed("macd_signal", "macd"),
        }
    )


def _stance(value: str, middle: str, base: str) -> Column:
    up = (F.col(value) > F.col(middle)) & (F.col(middle) > F.col(base))
    down = (F.col(value) < F.col(middle)) & (F.col(middle) < F.col(base))
    return F.when(up, "bullish").when(down, "bearish").otherwise("neutral")


def price_patterns(df: DataFrame, cfg: MarketConfig = MarketConfig(), key: str = "ticker") -> DataFrame:
    """Add the highest high and lowest low of the last rows, and the trend."""
    middle, base = (f"ma_{n}" for n in cfg.trend)
    frame = _last(cfg.pattern, key)
    return df.withColumns(
        {
            f"high_{cfg.pattern}d": F.max("high").over(frame),
            f"low_{cfg.pattern}d": F.min("low").over(frame),
            "trend": _stance("close", middle, base),
        }
    )


def trading_signals(df: DataFrame) -> DataFrame:
    """Add ``buy_signal``, ``sell_signal`` and ``signal_strength`` from the flags."""

    def on(flag: str) -> Column:
        return F.col(flag) == 1

    cross = on("golden_cross") | on("death_cross")
    extreme = on("rsi_oversold") | on("rsi_overbought")
    return df.withColumns(
        {
            "buy_signal": F.when(on("golden_cross"), "golden_cross")
            .when(on("rsi_oversold"), "rsi_oversold")
            .when(on("macd_bullish_cross"), "macd_bullish"),
            "sell_signal": F.when(on("death_cross"), "death_cross")
            .when(on("rsi_overbought"), "rsi_overbought")
            .when(on("macd_bearish_cross"), "macd_bearish"),
            "signal_strength": F.when(cross & extreme, "strong")
            .when(cross | extreme, "medium")
            .when(on("macd_bullish_cross") | on("macd_bearish_cross"), "weak"),
        }
    )


def analyse(daily: DataFrame, cfg: MarketConfig = MarketConfig(), key: str = "ticker") -> DataFrame:
    """Daily bars with every indicator, flag, pattern, signal and the change of the close."""
    df = moving_averages(daily, [cfg.short, cfg.long, *cfg.trend], key=key)
    df = macd(rsi(df, cfg.rsi, key=key), cfg.fast, cfg.slow, cfg.signal, key=key)
    df = pct_change(df, key=key)
    return trading_signals(price_patterns(crossovers(df, cfg, key), cfg, key))


def rsi_status(cfg: MarketConfig = MarketConfig()) -> Column:
    return (
        F.when(F.col("rsi").isNull() | (F.col("rsi") == 0), "unknown")
        .when(F.col("rsi") > cfg.overbought, "overbought")
        .when(F.col("rsi") < cfg.oversold, "oversold")
        .otherwise("neutral")
    )


def summarize(analysed: DataFrame, cfg: MarketConfig = MarketConfig(), key: str = "ticker") -> DataFrame:
    """The latest bar of every key with its indicators and statuses.

    The newest date comes from the partitioning the indicators already have, so neither a join nor
    another exchange is needed.
    """
    newest = F.max("date").over(W.partitionBy(key))
    latest = analysed.withColumn("_newest", newest).where(F.col("date") == F.col("_newest"))
    middle, base = (F.col(f"ma_{n}") for n in cfg.trend)
    return latest.select(
        key,
        "date",
        "open",
        "high",
        "low",
        "close",
        "volume",
        F.col(f"ma_{cfg.short}").alias("ma_short"),
        F.col(f"ma_{cfg.long}").alias("ma_long"),
        middle,
        base,
        "rsi",
        "macd",
        "macd_signal",
        "macd_histogram",
        "trend",
        "buy_signal",
        "sell_signal",
        "signal_strength",
        "change_pct",
        ((F.try_divide(middle, base) - 1.0) * 100).alias("ma_{}_{}_diff_pct".format(*cfg.trend)),
        rsi_status(cfg).alias("rsi_status"),
        _stance("close", f"ma_{cfg.short}", f"ma_{cfg.long}").alias("ma_status"),
    )
