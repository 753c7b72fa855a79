"""Table verbs that fail loudly where Spark would stay silent."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonnage.functions import is_missing, to_number


def quoted(name: str) -> Column:
    """Column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def require(df: DataFrame, names: Iterable[str]) -> None:
    """Raise when a named column is absent."""
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise ValueError(f"no column {absent} among {df.columns}")


def keep(df: DataFrame, *names: str) -> DataFrame:
    """Keep and reorder the named columns."""
    require(df, names)
    return df.select(*[quoted(n) for n in names])


def discard(df: DataFrame, *names: str) -> DataFrame:
    """Drop the named columns, all of which must exist."""
    require(df, names)
    return df.drop(*names)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename old to new; every old name must exist and no name may double."""
    require(df, names)
    after = [names.get(c, c) for c in df.columns]
    if len(set(after)) != len(after):
        raise ValueError(f"renaming {dict(names)} leaves two columns of one name: {after}")
    return df.select(*[quoted(old).alias(new) for old, new in zip(df.columns, after, strict=True)])


def mutate(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns one after another, so that a later one sees the earlier ones."""
    for name, value in columns.items():
        df = df.withColumn(name, value)
    return df


def missing_test(df: DataFrame, column: str) -> Column:
    """Null, or NaN where the column is floating-point."""
    floating = df.schema[column].dataType.typeName() in ("double", "float")
    return is_missing(quoted(column)) if floating else quoted(column).isNull()


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null or NaN in any of the columns (all by default)."""
    columns = list(columns or df.columns)
    require(df, columns)
    return df.na.drop("any", subset=[f"`{c}`" if "." in c else c for c in columns])


def split_missing(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """The rows where the column is present, and the rows where it is missing."""
    require(df, [column])
    missing = missing_test(df, column)
    return df.where(~missing), df.where(missing)


def flag_missing(df: DataFrame, column: str, out: str, present: str, missing: str) -> DataFrame:
    """A label on each row for whether the column is present: one pass where both parts are wanted."""
    require(df, [column])
    test = F.when(missing_test(df, column), F.lit(missing)).otherwise(F.lit(present))
    return df.withColumn(out, test)


def bind_rows(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Stack tables by column name; absent columns are null, types must agree."""
    out = first
    for other in others:
        types = {f.name: f.dataType for f in out.schema.fields}
        clash = [
            f"{f.name}: {types[f.name].simpleString()} and {f.dataType.simpleString()}"
            for f in other.schema.fields
            if f.name in types and types[f.name] != f.dataType
        ]
        if clash:
            raise TypeError(f"cannot stack columns of different types: {clash}")
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def longer(
    df: DataFrame,
    columns: Sequence[str],
    names_to: str,
    values_to: str = "value",
) -> DataFrame:
    """Columns to rows; missing values stay as rows."""
    require(df, columns)
    ids = [quoted(c) for c in df.columns if c not in columns]
    return df.unpivot(ids, [quoted(c) for c in columns], names_to, values_to)


def wider(
    df: DataFrame,
    names_from: str,
    values_from: str,
    values: Sequence,
    ids: Sequence[str] | None = None,
) -> DataFrame:
    """Rows to one column per listed value; a cell with two rows is an error.

    `ids` defaults to all other columns. The list of values is a parameter, so no
    job runs to discover it.
    """
    ids = list(ids or [c for c in df.columns if c not in (names_from, values_from)])
    require(df, [*ids, names_from, values_from])
    kind = df.schema[values_from].dataType
    cell = F.when(F.count(F.lit(1)) <= 1, F.first(quoted(values_from))).otherwise(
        F.raise_error(F.lit(f"two rows for one cell of {names_from}")).cast(kind)
    )
    return df.groupBy(*[quoted(c) for c in ids]).pivot(names_from, list(values)).agg(cell)


def find_names(df: DataFrame, column: str, most: int) -> list:
    """The distinct values of a column in order, found by one job.

    More than most of them, or a missing one, are an error, so no large column reaches the driver.
    """
    require(df, [column])
    found = [r[0] for r in df.select(quoted(column)).distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"{column} has more than {most} values")
    if None in found:
        raise ValueError(f"{column} has missing values")
    return sorted(found)


def wider_found(
    df: DataFrame, names_from: str, values_from: str, ids: Sequence[str] | None = None, most: int = 100
) -> DataFrame:
    """`wider` with the names that the data hold, at most so many; df is read once more to find them."""
    return wider(df, names_from, values_from, find_names(df, names_from, most), ids)


def across(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Every row once per value of a short literal list, with no join."""
    if column in df.columns:
        raise ValueError(f"column {column} exists already")
    return df.withColumn(column, F.explode(F.array(*[F.lit(v) for v in values])))


def year_table(spark, years: Sequence[int], column: str = "year") -> DataFrame:
    """One row per year."""
    return spark.range(1).select(
        F.explode(F.array(*[F.lit(int(y)) for y in years])).alias(column)
    )


def to_numbers(df: DataFrame, *columns: str) -> DataFrame:
    """Parse text columns to doubles; text that is not one plain number becomes null."""
    require(df, columns)
    return df.withColumns({c: to_number(quoted(c)) for c in columns})
