"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# UTC keeps TIMESTAMP and TIMESTAMP_NTZ columns interchangeable.  AQE re-plans joins from the
# sizes seen at run time, which is what decides every broadcast in this package: no operator
# forces one.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "tickstone", master: str | None = None, **conf: str) -> SparkSession:
    """Session for a job.  ``master`` stays unset under spark-submit so that its flag wins."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
