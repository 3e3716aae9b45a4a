"""Results that several later steps read."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


@lru_cache(maxsize=1)
def _own_folder() -> str:
    """A folder for a local session without the setting, removed when the process ends."""
    path = tempfile.mkdtemp(prefix="tickstone-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets a temporary folder.
    """
    shared = spark.conf.get(SETTING, None)
    if shared:
        return shared
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder that all executors share")
    return _own_folder()


def settled(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and keep it on shared storage, so that a lost executor costs no recomputation."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
