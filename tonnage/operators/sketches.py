"""Quantiles from sketches that are kept and added up, so that old rows need not be read again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonnage.operators.relational import missing_test, quoted, require

#: The larger, the finer: a quantile is off by less than 1 % of the ranks, and mostly by far less.
FINENESS = 400
RANK_ERROR = 0.01


def quantile_sketches(df: DataFrame, keys: Sequence[str], measure: str, fineness: int = FINENESS) -> DataFrame:
    """keys, n, n_missing and sketch: what the values of each group leave behind, some kB however many they are.

    Rows are sketched where they lie and only sketches are shuffled. A missing key is a group of its
    own; missing values are counted in n_missing and not sketched, and a group of such alone
    has no sketch.
    """
    require(df, [*keys, measure])
    missing = missing_test(df, measure)
    value = F.when(~missing, quoted(measure).cast("double"))
    groups = df.groupBy(*map(quoted, keys)).agg(
        F.count_if(~missing).alias("n"),
        F.count_if(missing).alias("n_missing"),
        F.kll_sketch_agg_double(value, F.lit(fineness)).alias("sketch"),
    )
    return groups.withColumn("sketch", F.when(F.col("n") > 0, F.col("sketch")))


def add_sketches(sketches: DataFrame, keys: Sequence[str], fineness: int = FINENESS) -> DataFrame:
    """One row per group from the rows of several `quantile_sketches`, such as one for each month."""
    require(sketches, [*keys, "n", "n_missing", "sketch"])
    groups = sketches.groupBy(*map(quoted, keys)).agg(
        F.sum("n").alias("n"), F.sum("n_missing").alias("n_missing"),
        F.kll_merge_agg_double("sketch", F.lit(fineness)).alias("sketch"),
    )
    return groups.withColumn("sketch", F.when(F.col("n") > 0, F.col("sketch")))


def sketched_quantile(sketches: DataFrame, share: float, out: str, strict: bool = True) -> DataFrame:
    """sketches with a value of about that rank in each group: of rank share, give or take RANK_ERROR.

    As with an exact median, a group with a missing value has none, unless strict is off.
    """
    if not 0 <= share <= 1:
        raise ValueError(f"a rank lies between 0 and 1, not at {share}")
    known = F.col("sketch").isNotNull()
    if strict:
        known = known & (F.col("n_missing") == 0)
    value = F.when(known, F.kll_sketch_get_quantile_double("sketch", F.lit(float(share))))
    return sketches.withColumn(out, value)
