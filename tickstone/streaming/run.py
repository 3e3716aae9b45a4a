"""Starting streaming queries."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickstone.functions import micros
from tickstone.operators.parse import flatten_window, to_topic
from tickstone.operators.windows import duration
from tickstone.sinks.replay import commit, latest_version, manifests, read_version, write_replay_safe

MODES = ("append", "update", "complete")


def start(
    df: DataFrame,
    sink: str | Callable[[DataFrame, int], None],
    mode: str = "append",
    checkpoint: str | None = None,
    name: str | None = None,
    options: Mapping[str, str] | None = None,
    available_now: bool = False,
    every: str | None = None,
) -> StreamingQuery:
    """Start ``df`` into a sink: a format name, or a function that gets each micro-batch.

    Durable sinks need a ``checkpoint`` on shared storage, so that a restarted query goes on where
    it stopped; only ``console`` and ``memory`` do without.  ``available_now`` works off what is
    there and stops; ``every`` sets a processing interval.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if checkpoint is None and sink not in ("console", "memory"):
        raise ValueError("this sink needs a checkpoint location")
    writer = df.writeStream.outputMode(mode).options(**(options or {}))
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    if callable(sink):
        return writer.foreachBatch(sink).start()
    return writer.format(sink).start()


def foreach_batch(write: Callable[[DataFrame, int], None], flat: bool = True) -> Callable[[DataFrame, int], None]:
    """Micro-batch sink that flattens windows to ISO text (unless ``flat`` is off) and skips empty batches.

    ``write`` gets a DataFrame and must accept a batch twice.  The batch is kept while it runs, so that state is
    read and rows are scored once, however many outputs it writes.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if not batch.isEmpty():
                write(flatten_window(batch) if flat and "window" in batch.columns else batch, batch_id)
        finally:
            batch.unpersist()

    return sink


def table_sink(root: str, name: str) -> Callable[[DataFrame, int], None]:
    """Sink for complete mode: a queryable table on shared storage.

    Every micro-batch writes the whole result as a new committed version; :func:`read_table_sink`
    reads the newest, and the one before stays for readers under way.  Unlike the ``memory`` format nothing passes
    through the driver.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        write_replay_safe({name: batch}, root, batch_id, keep=2)

    return sink


def late_split(root: str, ts: str, delay: str, name: str = "in_time", late: str = "late") -> Callable[[DataFrame, int], None]:
    """Sink that parts each micro-batch into rows in time and late ones, under ``root``; together they are the input.

    A row is late if it is more than ``delay`` older than the newest row of the micro-batches before.  That is what a
    watermark of this delay would drop; a stream over ``root``/``name`` with such a watermark drops nothing, because its
    watermark is never ahead.  The newest time is kept with the commit, so a micro-batch that runs again is split alike.
    """
    width = int(duration(delay).total_seconds() * 1_000_000)

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = next((m for m in manifests(spark, f"{root}/{name}-marks") if m.version < batch_id), None)
        high = earlier.parts.get("high") if earlier else None
        batch.persist()
        try:
            is_late = F.coalesce(micros(ts) < F.lit(high - width), F.lit(False)) if high is not None else F.lit(False)
            for part, rows in ((name, batch.where(~is_late)), (late, batch.where(is_late))):
                rows.write.mode("overwrite").parquet(f"{root}/{part}/batch_id={batch_id}")
            newest = batch.agg(F.max(micros(ts))).first()[0]
        finally:
            batch.unpersist()
        marks = [m for m in (high, newest) if m is not None]
        commit(spark, f"{root}/{name}-marks", batch_id, {"high": max(marks)} if marks else {})

    return sink


VERSION = "version"


def update_sink(keys: Sequence[str], fmt: str, options: Mapping[str, str]) -> Callable[[DataFrame, int], None]:
    """Sink for update mode: a topic in which the last record of a key holds.

    A record's key is the JSON of ``keys``, nested windows included; its value is the JSON of all columns and ``version``, the
    number of the micro-batch.  A micro-batch that is written again repeats its records, which changes nothing for
    :func:`newest_records`.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn(VERSION, F.lit(batch_id).cast("bigint"))
        records = to_topic(rows, F.to_json(F.struct(*keys)))
        records.write.format(fmt).options(**options).mode("append").save()

    return sink


def newest_records(records: DataFrame, schema: str) -> DataFrame:
    """The newest value of each key of such a topic as columns; ``schema`` describes the value without its version."""
    value = F.from_json(F.col("value").cast("string"), f"{schema}, {VERSION} BIGINT").alias("v")
    parsed = records.select(F.col("key").cast("string").alias("key"), value)
    newest = parsed.groupBy("key").agg(F.max_by("v", f"v.{VERSION}").alias("v"))
    return newest.select("v.*").drop(VERSION)


def read_table_sink(spark: SparkSession, root: str, name: str) -> DataFrame:
    version = latest_version(spark, root)
    if version is None:
        raise ValueError(f"no version of {name} has been committed yet")
    return read_version(spark, root, name, version)


def await_any(spark: SparkSession) -> None:
    """Wait until one of the running queries stops or fails."""
    spark.streams.awaitAnyTermination()
