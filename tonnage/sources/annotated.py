"""CSV files that carry a preamble of notes above the header line."""

from __future__ import annotations

import csv
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tonnage.functions import parse_grouped
from tonnage.sources.staging import stage

BOM = "\ufeff"
SPLIT_BYTES = "spark.sql.files.maxPartitionBytes"
OPEN_COST = "spark.sql.files.openCostInBytes"
MOST_PARTITIONS = "spark.sql.files.maxPartitionNum"


@contextmanager
def one_block_per_task(spark: SparkSession) -> Iterator[None]:
    """Let no task of a job that runs meanwhile read from more than one block of a file.

    Opening a file then counts as much as a whole partition, so Spark packs no two together.
    """
    before = {k: spark.conf.get(k, None) for k in (OPEN_COST, MOST_PARTITIONS)}
    size = spark.conf.get(SPLIT_BYTES)
    spark.conf.set(OPEN_COST, size)
    spark.conf.unset(MOST_PARTITIONS)
    try:
        if spark.conf.get(OPEN_COST) != size or spark.conf.get(MOST_PARTITIONS, None):
            raise RuntimeError(f"{OPEN_COST} and {MOST_PARTITIONS} cannot be set for the job that reads the files")
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _head(spark: SparkSession, files: list[str], n: int) -> list[str]:
    """The first n lines of the first file that has any."""
    for file in sorted(files):
        first = [r.value for r in spark.read.text(file).select(F.rtrim("value").alias("value")).limit(n).collect()]
        if first:
            return first
    return []


def _names(lines: list[str], skip: int) -> list[str]:
    if len(lines) <= skip:
        raise ValueError("a file ends before its header, or no file holds a line")
    return [name.strip() for name in next(csv.reader([lines[skip].removeprefix(BOM)]))]


def read_header(spark: SparkSession, path: str | list[str], skip: int = 0) -> list[str]:
    """Column names as the first file spells them, trimmed; `read_annotated` holds the others against it."""
    return _names(_head(spark, spark.read.text(path).inputFiles(), skip + 1), skip)


def _fields(line: Column, count: int, mode: str) -> Column:
    ddl = ", ".join(f"c{i} STRING" for i in range(count))
    return F.from_csv(line, ddl, {"mode": mode, "escape": '"'})


def read_annotated(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    skip: int = 0,
) -> DataFrame:
    """Read a CSV whose first `skip` lines are notes, with declared names and types.

    Fields are matched by position, trimmed, and parsed to the declared type; text
    that is no number is null, and commas inside quoted numbers are grouping marks.
    The notes and the header of each file go, and nothing else: a later line that looks
    like one of them is data. A folder of files reads as one table; files whose headers
    differ are an error, and so is a line with another number of fields. A quoted field may
    not hold a line break. Files without a line count for nothing.

    However many files there are, two jobs run: one reads the first file's header, and one
    reads all text once and stages the typed rows. In that job a task reads one block of one
    file, so the number of a line in its task, in the block where the file begins, is its number in the
    file; files stay splittable. The first block has to hold the notes and the header.
    """
    lines = spark.read.text(path)
    names = _names(_head(spark, lines.inputFiles(), skip + 1), skip)
    if len(names) != len(schema):
        raise ValueError(f"{len(schema)} columns are declared, the header reads {names}")
    # The lower 33 bits of this id count the rows of a partition.
    number = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    begins = F.col("_metadata.file_block_start") == 0
    place = F.when(begins, number).otherwise(F.lit(skip + 1))
    file = F.col("_metadata.file_path")
    lines = lines.select(F.rtrim("value").alias("value"), place.alias("place"), file.alias("file"))
    spelled = F.regexp_replace("value", f"^{BOM}", "")
    # A field more than declared shows a header that is longer.
    header = F.array(*[F.trim(F.col(f"h.c{i}")) for i in range(len(names) + 1)])
    wanted = F.array(*map(F.lit, names), F.lit(None).cast("string"))
    is_header = F.col("place") == skip
    other = is_header & ~header.eqNullSafe(wanted)
    seen = Observation()
    lines = lines.withColumn("h", F.when(is_header, _fields(spelled, len(names) + 1, "PERMISSIVE"))).observe(
        seen,
        F.count_if(F.col("place") == 0).alias("files"),
        F.count_if(is_header).alias("headers"),
        F.min(F.when(other, F.concat("file", F.lit(": "), "value"))).alias("other"),
    )
    body = lines.where((F.col("place") > skip) & (F.col("value") != ""))
    texts = body.select(_fields(F.col("value"), len(names), "FAILFAST").alias("r"))
    typed = texts.select(*[_typed(F.col(f"r.c{i}"), f) for i, f in enumerate(schema.fields)])
    with one_block_per_task(spark):
        table = stage(typed)
    found = seen.get
    if found["other"] is not None:
        raise ValueError(f"the files do not share one header: {names}, but {found['other']}")
    if found["headers"] < found["files"]:
        raise ValueError(f"{found['files'] - found['headers']} of {found['files']} files end before their header: before its header a file holds {skip} notes")
    return table


def _typed(text: Column, field: StructField) -> Column:
    text = F.trim(text)
    text = F.when(~text.isin("", "NA"), text)
    if isinstance(field.dataType, StringType):
        return text.alias(field.name)
    return parse_grouped(text).cast(field.dataType).alias(field.name)
