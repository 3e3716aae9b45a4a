"""Sinks that may be run again with the same batch and still hold every row exactly once.

A batch writes its outputs to ``<path>/<output>/batch_id=<n>``, replacing what an earlier attempt
left there, and then commits them with one small manifest: the ids of all committed batches as ranges, and for upserted tables
which batch holds the newest rows of each partition.  Readers go by the newest manifest, so several outputs
appear together or not at all.

The manifest has two slots, and a commit writes the slot that does not hold the newest one.  A crash while it is
written leaves the newest one whole.  Finding it means looking into two folders, however many batches there were.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickstone.operators.aggregates import merge_counts

_SCHEMA = "version BIGINT, ranges ARRAY<STRUCT<low: BIGINT, high: BIGINT>>, parts MAP<STRING, BIGINT>"


@dataclass
class Manifest:
    version: int = -1
    ranges: list[tuple[int, int]] = field(default_factory=list)  # committed batch ids, in order
    parts: dict[str, int] = field(default_factory=dict)  # partition of an upserted table -> batch that wrote it last
    slot: int = 1

    def with_batch(self, batch_id: int, parts: Mapping[str, int]) -> Manifest:
        ranges = list(self.ranges)
        if ranges and ranges[-1][1] == batch_id - 1:
            ranges[-1] = (ranges[-1][0], batch_id)
        else:
            ranges.append((batch_id, batch_id))
        return Manifest(batch_id, ranges, {**self.parts, **parts}, 1 - self.slot)


def manifests(spark: SparkSession, path: str) -> list[Manifest]:
    """What is in the two slots, newest first."""
    found = []
    for slot in (0, 1):
        try:
            rows = spark.read.schema(_SCHEMA).parquet(f"{path}/manifest/slot={slot}").collect()  # one row
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        found += [Manifest(r.version, [tuple(x) for x in r.ranges], dict(r.parts), slot) for r in rows]
    return sorted(found, key=lambda m: -m.version)


def newest_manifest(spark: SparkSession, path: str) -> Manifest:
    return next(iter(manifests(spark, path)), Manifest())


def _on_storage(spark: SparkSession, path: str) -> tuple:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever storage holds it."""
    storage, target = _on_storage(spark, path)
    storage.delete(target, True)


def make_folder(spark: SparkSession, path: str) -> None:
    storage, target = _on_storage(spark, path)
    storage.mkdirs(target)


def commit(spark: SparkSession, path: str, batch_id: int, parts: Mapping[str, int] = {}) -> None:
    """Add a batch to the newest manifest, unless it is there already."""
    known = newest_manifest(spark, path)
    if known.version >= batch_id:  # an earlier attempt got here
        return
    new = known.with_batch(batch_id, parts)
    row = spark.createDataFrame([(new.version, new.ranges, new.parts)], _SCHEMA)
    row.coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/slot={new.slot}")


def write_replay_safe(outputs: Mapping[str, DataFrame], path: str, batch_id: int, keep: int | None = None) -> None:
    """Write all outputs of one batch, then commit them together.

    ``keep``: each batch replaces the ones before, of which only the newest ``keep`` stay for readers under way.
    """
    if not outputs:
        raise ValueError("no outputs")
    spark = next(iter(outputs.values())).sparkSession
    for name, frame in outputs.items():
        frame.write.mode("overwrite").parquet(f"{path}/{name}/batch_id={batch_id}")
    before = newest_manifest(spark, path)
    commit(spark, path, batch_id)
    if keep is not None and before.version < batch_id:
        ids = [i for low, high in reversed(before.ranges[-keep - 1 :]) for i in range(high, max(low, high - keep) - 1, -1)]
        for old in ids[keep - 1 : keep]:  # one goes for each that comes
            for name in outputs:
                remove(spark, f"{path}/{name}/batch_id={old}")


def read_committed(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Rows of committed batches; folders of others are pruned."""
    rows = spark.read.option("basePath", f"{path}/{name}").parquet(f"{path}/{name}")
    rows = rows.withColumn("batch_id", F.col("batch_id").cast("bigint"))
    known = F.lit(False)
    for low, high in newest_manifest(spark, path).ranges:
        known = known | F.col("batch_id").between(low, high)
    return rows.where(known)


def latest_version(spark: SparkSession, path: str) -> int | None:
    version = newest_manifest(spark, path).version
    return version if version >= 0 else None


def read_version(spark: SparkSession, path: str, name: str, version: int) -> DataFrame:
    """What a table was after batch ``version``; of upserted tables the newest and the one before are known."""
    known = next((m for m in manifests(spark, path) if m.version == version), None)
    if known is None or not known.parts:
        return spark.read.parquet(f"{path}/{name}/batch_id={version}")
    return _read_parts(spark, f"{path}/{name}", known.parts)


def _read_parts(spark: SparkSession, root: str, parts: Mapping[str, int]) -> DataFrame:
    paths = [f"{root}/batch_id={batch}/part={part}" for part, batch in parts.items()]
    return spark.read.option("basePath", root).parquet(*paths).drop("batch_id", "part")


def upsert_counts(
    new: DataFrame,
    path: str,
    batch_id: int,
    keys: Sequence[str],
    value: str = "cnt",
    name: str = "counts",
    part: Column | None = None,
) -> None:
    """Merge counts into the table and commit the result as version ``batch_id``.

    ``part`` cuts the table by a function of the keys, such as the day: only the parts that ``new`` touches are read, merged and
    written, the others stay where they are.  Running a batch again changes nothing once it is committed.
    """
    spark = new.sparkSession
    known = newest_manifest(spark, path)
    if known.version >= batch_id:
        return
    root = f"{path}/{name}"
    cut = (part if part is not None else F.lit("all")).cast("string")
    cut = F.coalesce(F.regexp_replace(cut, "[^A-Za-z0-9_.-]", "_"), F.lit("none"))  # a plain folder name
    new = new.select(*keys, value).withColumn("part", cut)
    touched = sorted(r[0] for r in new.select("part").distinct().collect())  # parts of one batch
    stored = {p: known.parts[p] for p in touched if p in known.parts}
    merged = new
    if stored:
        old = _read_parts(spark, root, stored).withColumn("part", cut)
        merged = merge_counts(old, new, [*keys, "part"], value)
    merged.write.mode("overwrite").partitionBy("part").parquet(f"{root}/batch_id={batch_id}")
    held = manifests(spark, path)
    commit(spark, path, batch_id, {p: batch_id for p in touched})
    needed = {pair for m in [*held[:1], newest_manifest(spark, path)] for pair in m.parts.items()}
    for m in held[1:]:  # what only the manifest just replaced still named
        for p, batch in set(m.parts.items()) - needed:
            remove(spark, f"{root}/batch_id={batch}/part={p}")
