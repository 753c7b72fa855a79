"""Shares of a total, and splitting or allocating a total by them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonnage.functions import r_divide, zero_if_missing
from tonnage.operators.aggregate import group_sum, with_group_value
from tonnage.operators.joins import Keys, join_full, join_left
from tonnage.operators.relational import (
    bind_rows,
    discard,
    keep,
    longer,
    quoted,
    require,
    to_numbers,
    wider,
)


def tidy_measures(
    df: DataFrame,
    measures: Sequence[str],
    names_to: str,
    hierarchy: DataFrame,
    exclude: Mapping[str, str] | None = None,
) -> DataFrame:
    """One complete row per entity and measure, with the entity's parents attached.

    Rows whose column equals an excluded label (a total row) are left out, text is
    parsed to numbers and incomplete rows are dropped. The parents are attached before the
    measures become rows.
    """
    for column, unwanted in (exclude or {}).items():
        df = df.where(quoted(column) != unwanted)
    ids = [c for c in df.columns if c not in measures]
    parents = [c for c in hierarchy.columns if c not in ids]
    rows = longer(join_left(df, hierarchy, [c for c in ids if c in hierarchy.columns]), measures, names_to)
    rows = to_numbers(keep(rows, *ids, names_to, "value", *parents), "value")
    return rows.na.drop("any")


def share_of_total(
    df: DataFrame, group: Sequence[str], measure: str, out: str = "share", staged: bool = True
) -> DataFrame:
    """Each row's share of its group's total, as a new column; see `with_group_value`."""
    total = group_sum(df, group, measure, "__total")
    rows = with_group_value(df, group, total, staged)
    return rows.withColumn(out, r_divide(quoted(measure), "__total")).drop("__total")


def split_by_share(
    df: DataFrame, shares: DataFrame, on: Keys, measure: str, share: str = "share"
) -> DataFrame:
    """A parent's amount on each of its categories, by the category's share.

    Parents without categories and categories without a parent stay, with no amount.
    """
    rows = join_full(df, shares, on)
    return discard(rows.withColumn(measure, quoted(measure) * quoted(share)), share)


def split_by_fractions(
    df: DataFrame,
    measure: str,
    first: tuple[str, float],
    rest: tuple[str, str],
    lookup: DataFrame,
    on: Keys,
    percent: str,
    names_to: str,
) -> DataFrame:
    """A fixed fraction under one label; the remainder on two labels by a percentage.

    The percentage is looked up per row and counts as 0 where it is missing.
    """
    label, fraction = first
    by_percent, remainder = rest
    rows = join_left(df, lookup, on)
    other = quoted(measure) * F.lit(1 - fraction)
    part = zero_if_missing(quoted(percent)) * 0.01
    parts = rows.withColumns(
        {
            label: quoted(measure) * F.lit(fraction),
            by_percent: other * part,
            remainder: other * (1 - part),
        }
    )
    ids = [c for c in df.columns if c != measure]
    labels = [label, by_percent, remainder]
    return longer(keep(parts, *ids, *labels), labels, names_to, measure)


def split_by_percent(
    df: DataFrame,
    ids: Sequence[str],
    classes: Mapping[str, tuple[str, str, str]],
    class_column: str,
    measure: str,
    percents: DataFrame,
    names_to: str,
) -> DataFrame:
    """Each class of an entity on two labels by the entity's percentage for the class.

    `classes` maps a class to its percentage column and the labels of the remainder
    and of the percentage. An entity without a class gets a null amount for it.
    """
    amounts = wider(df, class_column, measure, list(classes), ids)
    rows = join_left(amounts, percents, list(ids))
    cells = []
    for name, (percent, remainder, part) in classes.items():
        fraction = quoted(percent) / 100
        for text, value in ((remainder, 1 - fraction), (part, fraction)):
            cells.append(
                F.struct(F.lit(text).alias(names_to), (quoted(name) * value).alias(measure))
            )
    return rows.select(*[quoted(c) for c in ids], F.inline(F.array(*cells)))


def allocate(
    totals: DataFrame, shares: DataFrame, on: Keys, measure: str, share: str = "share"
) -> DataFrame:
    """Parents' totals on their children, by the child's share of the parent."""
    rows = join_left(shares, totals, on)
    return rows.withColumn(measure, quoted(measure) * quoted(share))


def weighted_rollup(
    df: DataFrame,
    shares: DataFrame,
    child: Keys,
    keys: Sequence[str],
    measure: str,
    share: str = "share",
) -> DataFrame:
    """Sum of child value times child share per key.

    Shares count every child of a parent; a child without a value adds nothing, and
    the remaining shares are not scaled up.
    """
    rows = join_left(df, shares, child)
    return group_sum(rows.withColumn(measure, quoted(measure) * quoted(share)), keys, measure)


def rollup_sum(
    parts: Sequence[DataFrame], levels: Sequence[Sequence[str]], measure: str
) -> DataFrame:
    """Stack the parts and sum level by level, each level from the one before."""
    out = bind_rows(*parts)
    for keys in levels:
        out = group_sum(out, keys, measure)
    return out


def complete_capacity(capacity: DataFrame, hierarchy: DataFrame, on: Keys) -> DataFrame:
    """Capacity of the children whose parents are all known."""
    return join_left(capacity, hierarchy, on).na.drop("any")


def child_shares(
    capacity: DataFrame, hierarchy: DataFrame, on: Keys, parent: str, measure: str, staged: bool = True
) -> DataFrame:
    """Each child's share of its parent's capacity."""
    require(hierarchy, [parent])
    rows = complete_capacity(capacity, hierarchy, on)
    return discard(share_of_total(rows, [parent], measure, staged=staged), measure)
