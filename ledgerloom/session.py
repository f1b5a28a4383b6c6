"""Session settings that results depend on, and those that suit large inputs."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(name: str = "ledgerloom", **extra: str) -> SparkSession:
    """A session with SETTINGS; sizes of memory and partitions are left to the cluster."""
    builder = SparkSession.builder.appName(name)
    for key, value in (SETTINGS | extra).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
