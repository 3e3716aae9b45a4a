"""Working folders on storage that every executor sees."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from tickstone.operators.lineage import shared_folder


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/tickstone-{label}-{uuid.uuid4().hex}"
