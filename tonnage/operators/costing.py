"""Pricing a quantity and splitting a total cost into the priced part and the rest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonnage.functions import r_divide
from tonnage.operators.aggregate import group_centre, with_group_value
from tonnage.operators.joins import Keys, join_checked, join_left
from tonnage.operators.relational import quoted, rename


def price(
    df: DataFrame,
    prices: DataFrame,
    on: Keys,
    quantity: str,
    unit_price: str,
    rate: float,
    divisor: float,
    out: str,
) -> DataFrame:
    """Quantity times price, at a yearly charge rate, in the unit the divisor gives."""
    rows = join_left(df, prices, on)
    cost = quoted(quantity) * quoted(unit_price) * F.lit(rate) / F.lit(divisor)
    return rows.withColumn(out, cost)


def median_scalar(
    df: DataFrame, group: Sequence[str], measure: str, out: str = "scalar"
) -> DataFrame:
    """Group mean, group median, and each row relative to the median.

    The table of the groups is not staged again: what it is made from is.
    """
    centre = group_centre(df, group, measure, f"avg_{measure}", f"median_{measure}")
    rows = with_group_value(df, group, centre, staged=False)
    return rows.withColumn(out, r_divide(quoted(measure), quoted(f"median_{measure}")))


def scale_by(
    scalars: DataFrame, base: DataFrame, on: Keys, measure: str, scalar: str = "scalar"
) -> DataFrame:
    """The base amounts once per scalar row, multiplied by the scalar."""
    rows = join_left(scalars, base, on)
    return rows.withColumn(measure, quoted(measure) * quoted(scalar))


def residual(
    total: DataFrame, part: DataFrame, on: Sequence[str], measure: str, part_measure: str
) -> DataFrame:
    """Total minus part; a total, known or not, without exactly one known part is an error."""
    rows = join_checked(total, rename(part, {part_measure: "__part"}), on, guarded=[measure])
    return rows.withColumn(measure, quoted(measure) - F.col("__part")).drop("__part")
