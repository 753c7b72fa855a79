"""Let Python workers import this library where it is not installed, and send them texts in small batches."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: A batch of 10,000 long texts would be held several times over, on either side of the pipe.
MOST_BYTES = 8 << 20


def workers_find_library(spark: SparkSession) -> None:
    """Add the folder of the library to the workers' import path, and keep Arrow batches small.

    On a cluster the library is installed or sent with --py-files; this covers a session
    on the machine that holds the source folder. A smaller size of batches that the session
    already has is left as it is.
    """
    sizes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils
    if not 0 < sizes.byteStringAsBytes(spark.conf.get(BATCH_BYTES)) <= MOST_BYTES:
        spark.conf.set(BATCH_BYTES, str(MOST_BYTES))
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = [x for x in environment.get("PYTHONPATH", "").split(":") if x]
    if root not in paths:
        environment["PYTHONPATH"] = ":".join([*paths, root])
