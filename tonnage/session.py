"""Session settings the engine is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution merges shuffle partitions but never adds any. On a cluster set
# spark.sql.adaptive.coalescePartitions.initialPartitionNum to about the shuffled bytes over
# 128 MB (for 100 TB some 800,000 at most); without it a shuffle starts with 200.
PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # Recording the Python line of every column expression slows down plan building.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cpus: int | str = 8, name: str = "tonnage", **extra: str) -> SparkSession:
    """A session on this machine, for tests and measurements."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name)
    settings = SETTINGS | {
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.driver.memory": "8g",
    }
    for key, value in (settings | extra).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
