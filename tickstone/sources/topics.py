"""Topic sources.

A topic is read through the ``kafka`` format where that connector is deployed, or from parquet
files that hold the same envelope columns.  Both give the same DataFrame.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickstone import schemas
from tickstone.functions import literal
from tickstone.operators.parse import parse_topic


@dataclass(frozen=True)
class TopicSpec:
    topic: str
    format: str = "parquet"
    path: str | None = None
    offsets: str = "earliest"
    fail_on_data_loss: bool = True
    options: Mapping[str, str] = field(default_factory=dict)


def _as_utc(moment: datetime) -> datetime:
    return moment if moment.tzinfo else moment.replace(tzinfo=UTC)


def read_topic(
    spark: SparkSession,
    spec: TopicSpec,
    schema: str | None = None,
    streaming: bool = False,
    start: datetime | None = None,
    end: datetime | None = None,
    max_per_trigger: int | None = None,
) -> DataFrame:
    """Envelope rows of one topic, or its parsed records when ``schema`` is given.

    ``start``/``end`` bound the record time as ``[start, end)``.  They reach the source (offset
    lookup by time on ``kafka``, row-group pruning on parquet), so old records are not scanned.
    ``max_per_trigger`` bounds the intake of a micro-batch: offsets on ``kafka``, files otherwise.
    """
    reader = spark.readStream if streaming else spark.read
    if spec.format == "kafka":
        options = {"subscribe": spec.topic, "failOnDataLoss": str(spec.fail_on_data_loss).lower()}
        if start is not None:
            options["startingTimestamp"] = str(int(_as_utc(start).timestamp() * 1000))
            options["startingOffsetsByTimestampStrategy"] = "latest"
        else:
            options["startingOffsets"] = spec.offsets
        if not streaming:
            if end is not None:
                options["endingTimestamp"] = str(int(_as_utc(end).timestamp() * 1000))
            else:
                options["endingOffsets"] = "latest"
        elif max_per_trigger:
            options["maxOffsetsPerTrigger"] = str(max_per_trigger)
        frame = reader.format("kafka").options(**{**options, **spec.options}).load()
    else:
        reader = reader.schema(schemas.ENVELOPE).format(spec.format).options(**spec.options)
        if streaming and max_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_per_trigger))
        frame = reader.load(spec.path)
    frame = select_topic(frame, spec.topic, start, end)
    return parse_topic(frame, schema) if schema else frame


def select_topic(
    frame: DataFrame, topic: str, start: datetime | None = None, end: datetime | None = None
) -> DataFrame:
    """Envelope rows of one topic with a record time in ``[start, end)``."""
    frame = frame.where(F.col("topic") == topic)
    kind = frame.schema["timestamp"].dataType
    if start is not None:
        frame = frame.where(F.col("timestamp") >= literal(start, kind))
    if end is not None:
        frame = frame.where(F.col("timestamp") < literal(end, kind))
    return frame


def stream_files(
    spark: SparkSession, path: str, schema: str, fmt: str = "parquet", max_files: int | None = None
) -> DataFrame:
    """Stream over a table path; ``path`` may be a directory or one file."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    # A glob is accepted for a file as well as for a directory, a plain file path is not.
    return reader.load(f"{path[:-1]}[{path[-1]}]")


def or_fallback(frame: DataFrame, schema: str, path: str | None = None) -> DataFrame:
    """``frame`` if it has rows, else the parquet rows at ``path``, else an empty typed frame."""
    if not frame.isEmpty():
        return frame
    spark = frame.sparkSession
    return spark.read.schema(schema).parquet(path) if path else spark.createDataFrame([], schema)
