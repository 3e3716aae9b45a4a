"""The order-dependent rules on keyed state.

State is a few numbers per key (of the market events, those of a bucket of keys together) and survives restarts in the checkpoint.  The rows of a key within
one micro-batch are put in order of time; across micro-batches the order of arrival counts.  Bound
the intake per trigger at the source: a key's rows of one micro-batch meet in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tickstone.functions import micros
from tickstone.operators.alerts import (
    BASELINE_GAIN,
    BASELINE_KEEP,
    EventConfig,
    effective_change,
    price_alert_text,
)
from tickstone.operators.joins import with_threshold
from tickstone.operators.report import direction


def _in_order(pdfs: Iterator[pd.DataFrame], tie: str) -> pd.DataFrame:
    return pd.concat(list(pdfs), ignore_index=True).sort_values(["_us", tie], kind="stable")


def _type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


BUCKETS = 1 << 11


def market_events_stream(
    ticks: DataFrame,
    cfg: EventConfig = EventConfig(),
    key: str = "ticker",
    ts: str = "ts",
    tie: str = "seq",
    history: DataFrame | None = None,
    history_path: str | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """:func:`tickstone.operators.alerts.market_events` on a stream.

    ``history`` (key, prev_price, prev_volume), a static frame, gives keys their first baselines.  It is stored at
    ``history_path``, unless rows are there already, and comes in as rows of the first micro-batch: the state operator gets
    each row once, and no later micro-batch joins or reads the history.

    Keys are dealt into ``buckets`` by hash, each a group of the state operator that holds its keys' numbers: a group costs
    Python far more than the few rows of most keys.  The number must stay the same over restarts.
    """
    wait = int(cfg.cooldown * 1_000_000)
    known = ticks.where(F.col("price").isNotNull() & F.col("volume").isNotNull())  # others raise and change nothing
    rows = known.select(key, ts, tie, "price", "volume", micros(ts).alias("_us"), F.lit(False).alias("_seed"))
    if history is not None:
        if history_path is None:
            raise ValueError("a history needs a path on shared storage")
        given = history.where(F.col("prev_price").isNotNull() & F.col("prev_volume").isNotNull())
        given = given.select(key, F.col("prev_price").alias("price"), F.col("prev_volume").alias("volume"))
        given.write.mode("ignore").parquet(history_path)
        seeds = ticks.sparkSession.readStream.schema(given.schema).parquet(history_path)
        # a tie that is not NULL where there is one, for NULLs would turn a bucket's whole numbers into floating-point ones
        nothing = {ts: F.lit(None).cast(rows.schema[ts].dataType), tie: F.lit("0").try_cast(rows.schema[tie].dataType)}
        seeds = seeds.withColumns({**nothing, "_us": F.lit(0).cast("long"), "_seed": F.lit(True)})
        rows = rows.unionByName(seeds)
    # the NULL key has a bucket of its own, so that no other has a NULL among its keys
    bucket = F.when(F.col(key).isNull(), -1).otherwise(F.pmod(F.hash(key), F.lit(buckets)))
    rows = rows.withColumns({"_name": F.col(key).cast("string"), "_bucket": bucket})

    def step(group: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(pdfs), ignore_index=True)
        out = []
        held = {name: numbers for name, *numbers in state.get[0]} if state.exists else {}
        seeds = pdf[pdf["_seed"]]
        for name, price, volume in zip(seeds["_name"], seeds["price"].tolist(), seeds["volume"].tolist(), strict=True):
            held.setdefault(name, [price, volume, None, None, None, False])
        pdf = pdf[~pdf["_seed"]].sort_values(["_us", tie], kind="stable")
        for name, own, at, seq, price, volume, us in zip(
            pdf["_name"], pdf[key], pdf[ts], pdf[tie], pdf["price"].tolist(), pdf["volume"].tolist(), pdf["_us"].tolist(), strict=True
        ):
            numbers = held.get(name)
            if numbers is None:
                held[name] = [price, volume, None, None, None, True]
                continue
            if not numbers[5]:  # a key's first tick only sets baselines that no history has set
                numbers[5] = True
                continue
            base, base_volume, *last, _ = numbers
            if base:
                change = (price - base) / base * 100
                change_volume = (volume - base_volume) / base_volume * 100 if base_volume else 0.0
                rules = (
                    ("price_surge", change >= cfg.surge, price, base, change),
                    ("price_drop", change <= cfg.drop, price, base, change),
                    ("volume_surge", change_volume >= cfg.volume, volume, base_volume, change_volume),
                )
                for i, (kind, hit, current, previous, percent) in enumerate(rules):
                    if hit and (last[i] is None or us - last[i] > wait):
                        out.append((own, at, seq, kind, float(current), float(previous), float(percent)))
                        numbers[2 + i] = us
                        break
            numbers[0] = BASELINE_KEEP * base + BASELINE_GAIN * price
            numbers[1] = BASELINE_KEEP * base_volume + BASELINE_GAIN * volume
        stored = [
            (name, float(base), float(base_volume), *[None if v is None else int(v) for v in last], ticked)
            for name, (base, base_volume, *last, ticked) in held.items()
        ]
        state.update((stored,))
        if out:
            yield pd.DataFrame(out, columns=[key, ts, tie, "event_type", "current", "previous", "change_pct"])

    return rows.groupBy("_bucket").applyInPandasWithState(
        step,
        f"`{key}` {_type(rows, key)}, `{ts}` {_type(rows, ts)}, `{tie}` {_type(rows, tie)}, "
        "event_type string, current double, previous double, change_pct double",
        "held array<struct<name: string, price: double, volume: double, surge: bigint, drop: bigint, volume_surge: bigint, "
        "ticked: boolean>>",
        "append",
        GroupStateTimeout.NoTimeout,
    )


def price_alerts_stream(
    ticks: DataFrame,
    thresholds: DataFrame,
    default: float = 2.0,
    key: str = "ticker",
    ts: str = "ts",
    tie: str = "seq",
) -> DataFrame:
    """:func:`tickstone.operators.alerts.price_alerts` on a stream; only the last price is state."""
    sent = F.col("change_pct") if "change_pct" in ticks.columns else F.lit(0.0)
    rows = ticks.select(key, ts, tie, "close", sent.cast("double").alias("_sent"), micros(ts).alias("_us"))

    def step(group: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        pdf = _in_order(pdfs, tie)
        # a row is compared with the last price known before it
        first = state.get[0] if state.exists else None
        known = pd.concat([pd.Series([first], dtype="float64"), pdf["close"].astype("float64")]).ffill().tolist()
        state.update((None if pd.isna(known[-1]) else known[-1],))
        pdf["previous"] = known[:-1]
        compared = pdf[pdf["previous"].notna()]
        if len(compared):
            yield compared[[key, ts, tie, "close", "previous", "_sent"]]

    paired = rows.groupBy(key).applyInPandasWithState(
        step,
        f"`{key}` {_type(rows, key)}, `{ts}` {_type(rows, ts)}, `{tie}` {_type(rows, tie)}, "
        "close double, previous double, _sent double",
        "close double",
        "append",
        GroupStateTimeout.NoTimeout,
    )
    changed = paired.withColumn(
        "change_pct", effective_change(F.col("close"), F.col("previous"), F.col("_sent"))
    ).drop("_sent")
    limited = with_threshold(changed, thresholds, key, default)
    return limited.where(F.abs("change_pct") >= F.col("threshold")).select(
        key, ts, tie, "close", "previous", "change_pct", "threshold",
        direction("change_pct").alias("direction"), price_alert_text(key).alias("message"),
    )


def dedup_alerts_stream(
    alerts: DataFrame,
    seconds: float = 300,
    ts: str = "timestamp",
    tie: str = "id",
    watermark: str | None = None,
) -> DataFrame:
    """:func:`tickstone.operators.alerts.dedup_alerts` on a stream.

    With a ``watermark`` delay the state of an alert is dropped once it can no longer matter.
    """
    wait = int(seconds * 1_000_000)
    rows = alerts.withColumns({"_alert": F.to_json(F.struct("type", "message")), "_us": micros(ts)})
    if watermark:
        rows = rows.withWatermark(ts, watermark)
    columns = list(alerts.columns)

    def step(group: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        pdf = _in_order(pdfs, tie)
        last = state.get[0] if state.exists else None
        keep = []
        for us in pdf["_us"]:
            send = last is None or us - last >= wait
            if send:
                last = int(us)
            keep.append(send)
        state.update((last,))
        if watermark:
            state.setTimeoutTimestamp(max((last + wait) // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        if any(keep):
            yield pdf[keep][columns]

    return rows.groupBy("_alert").applyInPandasWithState(
        step,
        ", ".join(f"`{c}` {_type(alerts, c)}" for c in columns),
        "sent bigint",
        "append",
        GroupStateTimeout.EventTimeTimeout if watermark else GroupStateTimeout.NoTimeout,
    )
