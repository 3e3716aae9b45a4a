"""Price, volume and alert rules that depend on what came before.

These are the batch forms; ``tickstone.streaming.stateful`` has the same rules on keyed state.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickstone.functions import signed_change
from tickstone.operators.joins import with_threshold
from tickstone.operators.lineage import settled
from tickstone.operators.report import direction
from tickstone.operators.sequence import cooldown, ewma, previous_value

# Weights of the old average and the new value, and the message texts.
BASELINE_KEEP, BASELINE_GAIN = 0.7, 0.3
SURGE_TEXT = "%s 가격 급등: $%.2f → $%.2f (%.2f%%)"
DROP_TEXT = "%s 가격 급락: $%.2f → $%.2f (%.2f%%)"
VOLUME_TEXT = "%s 거래량 급증: %.0f → %.0f (%.2f%%)"
PRICE_ALERT_TEXT = "%s 주가가 %s%% 이상 %s했습니다: %.2f%%"
DIRECTION_TEXT = {"up": "상승", "down": "하락"}


@dataclass(frozen=True)
class EventConfig:
    surge: float = 3.0
    drop: float = -3.0
    volume: float = 50.0
    cooldown: float = 300.0

    def __post_init__(self):
        # The three rules are evaluated one after the other; that needs rules 1 and 2 to exclude each other.
        if self.drop >= self.surge:
            raise ValueError("the drop threshold must lie below the surge threshold")


def baselines(
    ticks: DataFrame,
    key: str = "ticker",
    ts: str = "ts",
    tie: str = "seq",
    history: DataFrame | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Add the moving price and volume baselines a tick is compared with; NULL on a key's first tick.

    ``history`` seeds them: one row per key with ``prev_price`` and ``prev_volume``.
    """
    columns = {
        "prev_price": ("price", BASELINE_KEEP, BASELINE_GAIN),
        "prev_volume": ("volume", BASELINE_KEEP, BASELINE_GAIN),
    }
    return ewma(ticks, key, ts, [tie], columns, "before", history, parts)


def market_events(
    ticks: DataFrame,
    cfg: EventConfig = EventConfig(),
    key: str = "ticker",
    ts: str = "ts",
    tie: str = "seq",
    history: DataFrame | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Surge, drop and volume events; at most one per tick, each type with its own cooldown.

    A tick is tried as a surge, then as a drop, then as a volume surge; a rule that is cooling down
    lets the next one try.  Surge and drop exclude each other, so each can be thinned out by itself,
    and the volume rule afterwards on the ticks neither of them took.  Ticks without a price or a volume raise
    nothing and leave the baselines as they are.
    """
    ticks = ticks.where(F.col("price").isNotNull() & F.col("volume").isNotNull())
    compared = baselines(ticks, key, ts, tie, history, parts).where(F.col("prev_price").isNotNull())
    measured = compared.withColumns(
        {
            "price_change": signed_change("price", "prev_price"),
            # A zero price baseline has no change, so the tick can raise no event of any kind.
            "volume_change": F.when(
                F.col("prev_price") != 0, F.coalesce(signed_change("volume", "prev_volume"), F.lit(0.0))
            ),
        }
    )
    rows = [key, ts, tie]
    surge = F.col("price_change") >= cfg.surge
    drop = F.col("price_change") <= cfg.drop
    volume = F.col("volume_change") >= cfg.volume
    # The few ticks that meet a rule are read several times below, so they are computed once.
    hits = settled(measured.where(surge | drop | volume))

    def kept(candidates: DataFrame, kind: str) -> DataFrame:
        thinned = cooldown(candidates.select(*rows), key, ts, tie, cfg.cooldown, False, parts)
        return thinned.withColumn("event_type", F.lit(kind))

    # The price rules of one key cool down separately, so both go through one pass under a joint key.
    kind = F.when(surge, "price_surge").otherwise("price_drop")
    priced = hits.where(surge | drop).select(
        F.concat_ws("\u0001", kind, F.col(key).cast("string")).alias("_rule"), *rows, kind.alias("event_type")
    )
    price_kept = cooldown(priced.select("_rule", ts, tie), "_rule", ts, tie, cfg.cooldown, False, parts)
    price_events = priced.join(price_kept, ["_rule", ts, tie], "left_semi").drop("_rule")
    volume_left = hits.where(volume).select(*rows).join(price_events, rows, "left_anti")
    fired = price_events.unionByName(kept(volume_left, "volume_surge"))
    by_price = F.col("event_type") != "volume_surge"
    return hits.join(fired, rows).select(
        *rows,
        "event_type",
        F.when(by_price, F.col("price")).otherwise(F.col("volume")).cast("double").alias("current"),
        F.when(by_price, F.col("prev_price")).otherwise(F.col("prev_volume")).alias("previous"),
        F.when(by_price, F.col("price_change")).otherwise(F.col("volume_change")).alias("change_pct"),
    )


def event_message(key: str = "ticker") -> Column:
    values = [F.col(key).cast("string"), F.col("previous"), F.col("current"), F.col("change_pct")]
    return (
        F.when(F.col("event_type") == "price_surge", F.format_string(SURGE_TEXT, *values))
        .when(F.col("event_type") == "price_drop", F.format_string(DROP_TEXT, *values))
        .otherwise(F.format_string(VOLUME_TEXT, *values))
    )


def market_event_alerts(events: DataFrame, key: str = "ticker", ts: str = "ts") -> DataFrame:
    """Alert rows for market events: price events are severe, volume events less so."""
    severity = F.when(F.col("event_type") == "volume_surge", "medium").otherwise("high")
    return events.select(
        F.col("event_type").alias("type"),
        key,
        event_message(key).alias("message"),
        severity.alias("severity"),
        F.col(ts).alias("timestamp"),
    )


def event_data(events: DataFrame, key: str = "ticker", ts: str = "ts") -> DataFrame:
    """Rows of the event table, the details as JSON encoded once."""
    by_price = F.col("event_type") != "volume_surge"
    stamp = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    head = [F.col("event_type").alias("type"), F.col(key).alias("ticker")]
    tail = [F.col("change_pct"), stamp.alias("timestamp")]
    price = F.struct(*head, F.col("current").alias("price"), F.col("previous").alias("prev_price"), *tail)
    volume = F.struct(*head, F.col("current").alias("volume"), F.col("previous").alias("prev_volume"), *tail)
    data = F.when(by_price, F.to_json(price)).otherwise(F.to_json(volume))
    return events.select(F.col(key).alias("ticker"), "event_type", F.col(ts).alias("timestamp"), data.alias("data"))


def effective_change(current: Column, previous: Column, sent: Column) -> Column:
    """The change a message brings along or, where it is 0 or missing, against the previous price."""
    computed = F.when(previous > 0, (current - previous) / previous * 100).otherwise(0.0)
    given = F.coalesce(sent, F.lit(0.0))
    return F.when(given == 0.0, computed).otherwise(given)


def price_alert_text(key: str = "ticker") -> Column:
    moved = F.when(direction("change_pct") == "up", DIRECTION_TEXT["up"]).otherwise(DIRECTION_TEXT["down"])
    return F.format_string(
        PRICE_ALERT_TEXT, F.col(key).cast("string"), F.col("threshold").cast("string"), moved, F.col("change_pct")
    )


def price_alerts(
    ticks: DataFrame,
    thresholds: DataFrame,
    default: float = 2.0,
    key: str = "ticker",
    ts: str = "ts",
    tie: str = "seq",
    parts: int | None = None,
) -> DataFrame:
    """Ticks whose change reaches the key's threshold.  A key's first tick never alerts."""
    before = previous_value(ticks, key, ts, [tie], "close", "previous", parts)
    sent = F.col("change_pct") if "change_pct" in ticks.columns else F.lit(0.0)
    changed = before.where(F.col("previous").isNotNull()).withColumn(
        "change_pct", effective_change(F.col("close"), F.col("previous"), sent)
    )
    limited = with_threshold(changed, thresholds, key, default)
    hits = limited.where(F.abs("change_pct") >= F.col("threshold"))
    return hits.select(
        key,
        ts,
        tie,
        "close",
        "previous",
        "change_pct",
        "threshold",
        direction("change_pct").alias("direction"),
        price_alert_text(key).alias("message"),
    )


def dedup_alerts(
    alerts: DataFrame,
    seconds: float = 300,
    ts: str = "timestamp",
    tie: str = "id",
    parts: int | None = None,
) -> DataFrame:
    """Drop an alert if the same type and message (NULL counts as one) was *sent* less than ``seconds`` before."""
    keyed = alerts.withColumn("_alert", F.to_json(F.struct("type", "message")))  # never NULL
    sent = cooldown(keyed, "_alert", ts, tie, seconds, True, parts)
    return keyed.join(sent, ["_alert", ts, tie], "left_semi").drop("_alert")


def dedup_messages(df: DataFrame, ids: str = "id", watermark: tuple[str, str] | None = None) -> DataFrame:
    """One row per message id, however often it was resent.

    On a stream ``watermark`` = (time column, delay) bounds how long ids are remembered.
    """
    if df.isStreaming and watermark:
        return df.withWatermark(*watermark).dropDuplicatesWithinWatermark([ids])
    return df.dropDuplicates([ids])
