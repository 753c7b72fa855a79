"""Fitting y = exp(a + b log x) per group from sums that can be kept, added up and fitted again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonnage.operators.relational import quoted, require

#: Logarithms of doubles stay below 750, so their sums keep 18 decimals over 10^14 rows.
EXACT = "decimal(28,18)"
ADDED = ("n", "n_left_out", "sum_x", "sum_y", "sum_xx", "sum_xy", "sum_yy")


def _positive(column: Column) -> Column:
    """Whether a number is positive and finite: NaN counts as greater than infinity here."""
    return (column > 0) & (column < float("inf"))


def loglog_sums(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """What a fit of log y on log x needs, one row per group: counts, sums of logs and their range.

    Rows with a missing, non-positive or infinite x or y have no logarithm to fit and are counted
    in n_left_out. Sums are decimals of logs rounded to 18 places, so they depend on neither the
    order of rows nor how they are split, and sums of parts, added by `add_sums`, are those of the whole.
    A missing key is a group of its own.
    """
    require(df, [*keys, x, y])
    a, b = quoted(x).cast("double"), quoted(y).cast("double")
    usable = F.coalesce(_positive(a) & _positive(b), F.lit(False))
    logs = df.select(
        *map(quoted, keys), usable.alias("__u"),
        F.when(usable, F.ln(a)).alias("__x"), F.when(usable, F.ln(b)).alias("__y"),
    )
    lx, ly = F.col("__x"), F.col("__y")
    terms = {"sum_x": lx, "sum_y": ly, "sum_xx": lx * lx, "sum_xy": lx * ly, "sum_yy": ly * ly}
    none = F.lit(0).cast("decimal(38,18)")
    return logs.groupBy(*map(quoted, keys)).agg(
        F.count_if("__u").alias("n"),
        F.count_if(~F.col("__u")).alias("n_left_out"),
        *[F.coalesce(F.sum(t.cast(EXACT)), none).alias(c) for c, t in terms.items()],
        F.min(lx).alias("least_x"),
        F.max(lx).alias("most_x"),
    )


def add_sums(sums: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per group from the rows of several `loglog_sums`, as if all their input had been one."""
    require(sums, [*keys, *ADDED, "least_x", "most_x"])
    totals = [F.sum(c).alias(c) for c in ADDED]
    return sums.groupBy(*map(quoted, keys)).agg(*totals, F.min("least_x").alias("least_x"), F.max("most_x").alias("most_x"))


def fit_line(sums: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, a, b, r2, n and n_left_out: the least-squares line log y = a + b log x of each group.

    Without two rows of different x there is no line, and a, b and r2 are null; r2 is null as well
    where all y are equal. The last step is in doubles: relative to the slope its error is about
    10^-16 times the mean square of log x over its variance.
    """
    require(sums, [*keys, *ADDED, "least_x", "most_x"])
    n, sx, sy, sxx, sxy, syy = (F.col(c).cast("double") for c in ("n", "sum_x", "sum_y", "sum_xx", "sum_xy", "sum_yy"))
    spread = (F.col("n") >= 2) & (F.col("least_x") < F.col("most_x"))
    across, along, up = sxy - sx * (sy / n), sxx - sx * (sx / n), syy - sy * (sy / n)
    rows = sums.withColumn("b", F.when(spread, across / along))
    rows = rows.withColumn("a", (F.col("sum_y").cast("double") - F.col("b") * sx) / n)
    r2 = F.when(spread & (up > 0), F.least(F.lit(1.0), across * across / (along * up)))
    return rows.withColumn("r2", r2).select(*map(quoted, keys), "a", "b", "r2", "n", "n_left_out")


def fit_loglog(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """The lines of `fit_line` straight from rows."""
    return fit_line(loglog_sums(df, keys, x, y), keys)
