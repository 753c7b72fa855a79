"""CSV export with the spelling a downstream reader expects, and Parquet that is replaced by partition."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, StringType, StructType


def _require(df: DataFrame, columns: Sequence[str]) -> None:
    """Fail on names that df does not have."""
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"no column {missing} in {df.columns}")


def _quoted(text: str | Column) -> Column:
    text = F.lit(text) if isinstance(text, str) else text
    return F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))


def _field(column: Column, kind: DataType) -> Column:
    """A field's text: quoted if it is text, NA if it is missing."""
    if isinstance(kind, StringType):
        return F.coalesce(_quoted(column), F.lit("NA"))
    text = column.cast("string")
    if isinstance(kind, DoubleType | FloatType):
        text = F.regexp_replace(text, "Infinity", "Inf")
    return F.coalesce(text, F.lit("NA"))


def write_csv(
    df: DataFrame,
    path: str,
    names: Mapping[str, str] | None = None,
    notes: Sequence[str] = (),
    order: Sequence[str] = (),
    one_head: bool = False,
) -> None:
    """Write a folder of CSV parts, each with notes, a header, and its share of the rows.

    Text and column names are quoted, with doubled quotes inside; a missing value is a bare
    NA, so the text "NA" differs from it; infinity reads Inf. `names` maps our column names
    to the spelling wanted in the header. A part without rows holds nothing.

    With `order` the rows are sorted by those columns, missing values first, over all parts: a part
    takes up where the one before it, by name, ends. No task sorts more than its part. With
    `one_head` as well, the notes and the header stand in the first part alone, so that the parts,
    one after the other, are the one file that a plain writer would make; a table without rows then still
    has a header.
    """
    names = names or {}
    _require(df, order)
    if one_head and not order:
        raise ValueError("one_head needs an order, which says what the first part is")
    line = F.concat_ws(",", *[_field(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields])
    head = [*map(F.lit, notes), F.concat_ws(",", *[_quoted(names.get(c, c)) for c in df.columns])]
    keys = [F.col(f"`{c}`").alias(f"key_{i}") for i, c in enumerate(order)]
    rows = df.select(line.alias("line"), F.lit(1).alias("below"), *keys)
    if one_head:
        top = df.sparkSession.range(1).select(F.concat_ws("\n", *head).alias("line"), F.lit(0).alias("below"))
        rows = top.unionByName(rows, allowMissingColumns=True)
    if order:
        along = ["below", *[f"key_{i}" for i in range(len(order))]]
        rows = rows.repartitionByRange(*along).sortWithinPartitions(*along)
    if one_head:
        value = F.col("line")
    else:
        # The lower 33 bits of this id count the rows of a partition.
        first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
        value = F.when(first, F.concat_ws("\n", *head, F.col("line"))).otherwise(F.col("line"))
    rows.select(value.alias("value")).write.text(path)


def write_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Write df as Parquet with a folder for each combination of the key columns by.

    Where path holds such a table already, only the combinations that df holds are replaced, each
    as a whole; the others stay. So a job that is run again for its own combinations leaves
    the table as if it had run once. Rows of a combination are brought together first, and Spark splits one
    that is too large for a task, so folders hold few files, none of them made by a task with more
    than its share. A missing key has a folder of its own; an empty text as key, which a folder's name
    cannot tell from a missing one, is an error, and so is a table with no column besides its keys.
    """
    _require(df, by)
    if not by or set(by) >= set(df.columns):
        raise ValueError(f"keys {list(by)} have to be some of the columns {df.columns}, not all")
    empty = F.raise_error(F.lit("an empty text cannot be a key of a partition")).cast("string")
    texts = [c for c in by if isinstance(df.schema[c].dataType, StringType)]
    keyed = df.withColumns({c: F.when(F.col(f"`{c}`") == "", empty).otherwise(F.col(f"`{c}`")) for c in texts})
    writer = keyed.hint("rebalance", *[F.col(f"`{c}`") for c in by]).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def read_partitions(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table that `write_partitions` wrote, with the columns and types of schema.

    Types of keys are taken from the schema: guessed from folder names, the text 007 would read 7.
    """
    return spark.read.schema(schema).parquet(path).select(*[F.col(f"`{c}`") for c in schema.names])
