"""Stocks times coefficients, and amounts per unit of capacity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonnage.functions import factor, factors_to, listed_units, label, r_divide, recode
from tonnage.operators.aggregate import group_mean, group_sum
from tonnage.operators.joins import Keys, join_inner, join_left
from tonnage.operators.relational import find_names, keep, quoted, require, split_missing, wider


def sum_components(df: DataFrame, keys: Sequence[str], measure: str, named: str) -> DataFrame:
    """Sum the components of each key, over the rows where `named` is present."""
    present, _ = split_missing(df, named)
    return group_sum(present, keys, measure)


def _joined(df: DataFrame, other: DataFrame, on: Keys, complete: bool) -> DataFrame:
    """With `complete` incomplete rows go afterwards, so missing keys need no match."""
    return join_inner(df, other, on, nulls="never") if complete else join_left(df, other, on)


def apply_coefficients(
    stock: DataFrame,
    coefficients: DataFrame,
    on: Keys,
    measure: str,
    coefficient: str,
    unit: str,
    complete: bool = True,
) -> DataFrame:
    """Stock times each of its coefficients, in the given unit.

    With `complete`, rows that lack a coefficient or any other value are dropped,
    which is why an inner join is enough.
    """
    rows = _joined(stock, coefficients, on, complete)
    rows = (
        rows
        .withColumn(measure, quoted(measure) * quoted(coefficient))
        .withColumn("unit", F.lit(unit))
    )
    return rows.na.drop("any") if complete else rows


def recode_and_sum(
    df: DataFrame, column: str, new: Column, keys: Sequence[str], measure: str
) -> DataFrame:
    """Replace a class by a coarser one and sum again."""
    require(df, [column])
    return group_sum(df.withColumn(column, new), keys, measure)


def ratio_to(
    df: DataFrame,
    base: DataFrame,
    on: Keys,
    measure: str,
    base_measure: str,
    unit: str,
    scale: float = 1.0,
    complete: bool = True,
) -> DataFrame:
    """Amount per unit of the base; `scale` converts the base's unit first.

    The base's column is kept under its own name, so it must differ from `measure`.
    """
    if measure == base_measure:
        raise ValueError("rename the base's measure before dividing by it")
    rows = _joined(df, base, on, complete)
    rows = (
        rows
        .withColumn(measure, r_divide(quoted(measure), quoted(base_measure) * scale))
        .withColumn("unit", F.lit(unit))
    )
    return rows.na.drop("any") if complete else rows


def derive_units(
    df: DataFrame,
    per_unit: DataFrame,
    on: Keys,
    measure: str,
    rate: str,
    class_column: str,
    classes: Mapping[str, str],
    unit_column: str,
    names_to: str,
) -> DataFrame:
    """Equipment counts from an amount and a rate, labelled with class and unit."""
    rows = join_left(df, per_unit, on)
    return (
        rows.withColumn(measure, quoted(rate) * quoted(measure))
        .withColumn(class_column, recode(quoted(class_column), classes))
        .withColumn(names_to, label(quoted(class_column), quoted(unit_column), sep=" "))
    )


def convert(
    df: DataFrame,
    measure: str,
    steps: Sequence[tuple[str, float]],
    out: str | None = None,
    unit: str | None = None,
) -> DataFrame:
    """A chain of ("*", factor) and ("/", factor) steps on one measure, in the given unit."""
    require(df, [measure])
    value = quoted(measure)
    for sign, amount in steps:
        if sign not in ("*", "/"):
            raise ValueError(f"a step is * or /, not {sign}")
        value = value * F.lit(amount) if sign == "*" else value / F.lit(amount)
    out = df.withColumn(out or measure, value)
    return out if unit is None else out.withColumn("unit", F.lit(unit))


def convert_to(
    df: DataFrame,
    measure: str,
    to_unit: str,
    unit_column: str = "unit",
    also: Sequence[str] = (),
    strict: bool = True,
) -> DataFrame:
    """Each row from its own unit into one unit, over the steps that the factors need.

    Rows may be in any listed unit that measures the same as to_unit, or in one of also: units
    with a stroke, such as kg/kW, that are converted part by part. A row without a unit has no
    value in the new one. A row in another unit stops the job when its value is read; unless
    strict, it has no value either, and keeps its unit.
    """
    units = factors_to(to_unit) if "/" not in to_unit or to_unit in listed_units() else {to_unit: 1.0}
    units |= {u: factor(u, to_unit) for u in also}
    rows = convert_each(df, measure, {u: (to_unit, f) for u, f in units.items()}, unit_column)
    if not strict:
        return rows
    other = F.concat(F.lit(f"no factor to {to_unit} for a row in "), quoted(unit_column))
    kind = rows.schema[measure].dataType
    fine = quoted(unit_column).isNull() | (quoted(unit_column) == to_unit)
    return rows.withColumn(measure, F.when(fine, quoted(measure)).otherwise(F.raise_error(other).cast(kind)))


def convert_each(
    df: DataFrame, measure: str, factors: Mapping[str, tuple[str, float]], unit_column: str = "unit"
) -> DataFrame:
    """Each row by the factor of its own unit, which then reads the unit it was turned into.

    `factors` maps a unit to its new unit and the factor. A row in another unit, or in none,
    has no value in the new one and keeps its unit.
    """
    require(df, [measure, unit_column])
    by = recode(quoted(unit_column), {u: float(f) for u, (_, f) in factors.items()})
    to = recode(quoted(unit_column), {u: new for u, (new, _) in factors.items()})
    return df.withColumn(measure, quoted(measure) * by).withColumn(
        unit_column, F.coalesce(to, quoted(unit_column))
    )


def compare_sources(
    df: DataFrame, source: str, sources: Sequence[str], measure: str
) -> DataFrame:
    """The sources of a measure side by side, one column each."""
    return wider(df, source, measure, sources)


def source_differences(
    df: DataFrame, source: str, measure: str, ids: Sequence[str] | None = None, most: int = 20
) -> DataFrame:
    """How far the sources of a measure lie apart: one row per id and pair of the sources that df holds.

    Columns: ids (by default all others), source_a, source_b, value_a, value_b, difference
    (b - a), ratio (b / a, as `r_divide`). Of a pair, the name that comes first is a. Where a source has no row or no value
    for an id, what needs it is null. Two rows of one source for an id, a missing source, and more
    than most sources are errors. One job finds the sources; the rows are aggregated once by id, into a map.
    """
    ids = list(ids or [c for c in df.columns if c not in (source, measure)])
    require(df, [*ids, source, measure])
    names = find_names(df, source, most)
    cells = df.groupBy(*map(quoted, ids), quoted(source).alias("__source")).agg(
        F.count(F.lit(1)).alias("__n"), F.any_value(quoted(measure)).alias("__value")
    )
    twice = F.raise_error(F.lit(f"two rows of one {source} for one of {ids}")).cast(df.schema[measure].dataType)
    cells = cells.withColumn("__value", F.when(F.col("__n") == 1, F.col("__value")).otherwise(twice))
    # A map has one entry for each source at most, and these are few.
    values = F.map_from_entries(F.collect_list(F.struct("__source", "__value")))
    by_id = cells.groupBy(*map(quoted, ids)).agg(values.alias("__values"))
    pairs = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in combinations(names, 2)]
    if not pairs:
        by_id, pairs = by_id.where(F.lit(False)), [F.struct(F.lit("").alias("a"), F.lit("").alias("b"))]
    rows = by_id.withColumn("__pair", F.explode(F.array(*pairs)))
    a, b = (F.try_element_at("__values", F.col(f"__pair.{x}")) for x in "ab")
    rows = rows.select(
        *map(quoted, ids), F.col("__pair.a").alias("source_a"), F.col("__pair.b").alias("source_b"),
        a.alias("value_a"), b.alias("value_b"),
    )
    x, y = F.col("value_a"), F.col("value_b")
    return rows.withColumns({"difference": y - x, "ratio": r_divide(y, x)})


def blend(
    df: DataFrame,
    exclude: Mapping[str, str],
    keys: Sequence[str],
    measure: str,
    year: int,
) -> DataFrame:
    """Mean over the sources, leaving out the rows that match all excluded labels."""
    require(df, exclude)
    unwanted = F.lit(True)
    for column, value in exclude.items():
        unwanted = unwanted & (quoted(column) == value)
    means = group_mean(df.where(~unwanted), keys, measure)
    return keep(means.withColumn("year", F.lit(year)), *keys, measure, "year")
