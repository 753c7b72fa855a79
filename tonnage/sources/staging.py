"""Write an intermediate table once so that its true size is known to the planner."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_staged: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it.

    Only a session that runs on this machine may fall back to a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tonnage-"))
    return context.getCheckpointDir().rstrip("/")


@contextmanager
def shuffle_files_dropped(spark: SparkSession) -> Iterator[None]:
    """Let Spark drop the shuffle files of each query run meanwhile as soon as it ends."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def stage(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it back.

    The result no longer depends on the upstream lineage, so a lost executor costs
    a re-read. Its size on disk is known, so a later join broadcasts it only when it
    is under spark.sql.autoBroadcastJoinThreshold and shuffles it otherwise. The shuffle
    files behind it are dropped once it is written. Staging runs a job when it is called.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/staged-{uuid.uuid4().hex}"
    with shuffle_files_dropped(spark):
        df.write.parquet(path)
    _staged.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame) -> Iterator[DataFrame]:
    """df as stage() gives it, deleted on leaving: for what only the steps inside read."""
    table = stage(df)
    path = _staged[-1]
    try:
        yield table
    finally:
        _staged.remove(path)
        _delete(df.sparkSession, path)


def staged_alone(spark: SparkSession, build: Callable[[], DataFrame]) -> DataFrame:
    """What build returns, staged, while all that build staged on the way is deleted."""
    before = set(_staged)
    table = stage(build())
    for path in [p for p in _staged[:-1] if p not in before]:
        _staged.remove(path)
        _delete(spark, path)
    return table


def _delete(spark: SparkSession, path: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> int:
    """Delete the tables this process has staged and return their number.

    To be called once nothing that reads them will run again.
    """
    count = len(_staged)
    while _staged:
        _delete(spark, _staged.pop())
    return count
