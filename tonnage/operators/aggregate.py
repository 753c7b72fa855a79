"""Grouped aggregates, among them an exact median that no single task has to hold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonnage.functions import strict_mean, strict_sum
from tonnage.operators.joins import join_inner, join_left, rows_without_match
from tonnage.operators.relational import missing_test, quoted, require
from tonnage.sources.staging import stage


def group_sum(df: DataFrame, keys: Sequence[str], measure: str, out: str | None = None) -> DataFrame:
    """Strict sum per group; a null key is a group of its own."""
    require(df, [*keys, measure])
    total = strict_sum(quoted(measure)).alias(out or measure)
    return df.groupBy(*[quoted(k) for k in keys]).agg(total)


def group_mean(df: DataFrame, keys: Sequence[str], measure: str, out: str | None = None) -> DataFrame:
    """Strict mean per group."""
    require(df, [*keys, measure])
    mean = strict_mean(quoted(measure)).alias(out or measure)
    return df.groupBy(*[quoted(k) for k in keys]).agg(mean)


# Spark keeps an approximate percentile within 1 / ACCURACY of the wanted rank. The
# bracket around the median reaches ten times as far to either side.
ACCURACY = 10_000
REACH = 10 / ACCURACY


def group_median(
    df: DataFrame, keys: Sequence[str], measure: str, out: str = "median", reach: float = REACH
) -> DataFrame:
    """Exact median per group, null as soon as one value in the group is missing.

    One pass takes the size of each group and a narrow bracket around its median from
    a sketch of bounded size. A second pass counts what lies below the bracket and
    selects within it, so only a small part of a group of any size is ever shuffled.
    A group whose bracket should miss its median is done again over all its values.
    Two tables are staged on the way, so jobs run when this is called.
    """
    return group_centre(df, keys, measure, None, out, reach)


def group_centre(
    df: DataFrame, keys: Sequence[str], measure: str, mean: str | None, median: str, reach: float = REACH
) -> DataFrame:
    """Strict mean and exact median (see `group_median`) per group from the same passes."""
    require(df, [*keys, measure])
    keys, out = list(keys), median
    by = [quoted(k) for k in keys]
    value = quoted(measure).cast("double").alias("__v")
    rows = df.select(*by, value, missing_test(df, measure).alias("__na"))
    means = {} if mean is None else {mean: strict_mean("__v").alias(mean)}
    known = F.when(~F.col("__na"), F.col("__v"))
    bracket = F.percentile_approx(known, [0.5 - reach, 0.5 + reach], ACCURACY)
    groups = stage(
        rows.groupBy(*by).agg(
            F.count(F.lit(1)).alias("__total"),
            F.max("__na").alias("__any_na"),
            F.min(known).alias("__min"),
            F.max(known).alias("__max"),
            bracket.alias("__q"),
            *means.values(),
        )
    )
    complete = groups.where(~F.col("__any_na"))
    low, high = F.col("__q")[0].alias("__lo"), F.col("__q")[1].alias("__hi")
    found = _select_middle(rows, keys, complete.select(*by, "__total", low, high), out)
    missed = rows_without_match(complete, found, keys)
    if not missed.isEmpty():
        low, high = F.col("__min").alias("__lo"), F.col("__max").alias("__hi")
        rest = _select_middle(rows, keys, missed.select(*by, "__total", low, high), out)
        found = found.unionByName(rest)
    return join_left(groups.select(*by, *map(quoted, means)), found, keys)


def _select_middle(rows: DataFrame, keys: list[str], bounds: DataFrame, out: str) -> DataFrame:
    """The median of each group whose middle values lie within the group's bounds.

    Values below the bounds are only counted. Equal values are counted before the
    first shuffle. The counts are range-partitioned on (keys, value), which cuts a
    group into ordered chunks; the chunk totals give the rank at which each chunk
    starts, and only the chunks that hold a middle rank are read again.
    """
    by = [quoted(k) for k in keys]
    near = join_inner(rows, bounds, keys).where(F.col("__v") <= F.col("__hi"))
    inside = F.when(F.col("__v") >= F.col("__lo"), F.col("__v"))  # null, sorted first, below
    counts = near.groupBy(*by, "__total", inside.alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    chunks = stage(
        counts.repartitionByRange(*by, "__v").withColumn("__chunk", F.spark_partition_id())
    )

    sizes = chunks.groupBy(*by, "__total", "__chunk").agg(F.sum("__n").alias("__size"))
    before = Window.partitionBy(*by).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("__size").over(before), F.lit(0))
    low, high = F.expr("(__total + 1) div 2"), F.expr("(__total + 2) div 2")
    middle = sizes.withColumn("__start", start).where(
        (high > F.col("__start")) & (low <= F.col("__start") + F.col("__size"))
    )

    hits = join_inner(chunks, middle.drop("__total"), [*keys, "__chunk"])
    upto = Window.partitionBy(*by, "__chunk").orderBy("__v")
    passed = F.sum("__n").over(upto.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = hits.withColumn("__last", F.col("__start") + passed)
    ranked = ranked.withColumn("__first", F.col("__last") - F.col("__n") + 1)
    at_low, at_high = (
        F.max(F.when((F.col("__first") <= rank) & (rank <= F.col("__last")), F.col("__v")))
        for rank in (low, high)
    )
    medians = ranked.groupBy(*by).agg(((at_low + at_high) / 2).alias(out))
    return medians.where(F.col(out).isNotNull())


def with_group_value(
    df: DataFrame, keys: Sequence[str], value: DataFrame, staged: bool = True
) -> DataFrame:
    """Attach one row per group to every row of the group.

    A window over the group would move every row of a large group to one task. The
    per-group table is small and of known size after staging, so df stays in place
    when the table can be broadcast. Staging runs a job at once; without it the planner
    learns the size while it runs, which is enough where df itself is small.
    """
    return join_left(df, stage(value) if staged else value, list(keys))


def with_group_mean(df: DataFrame, keys: Sequence[str], measure: str, out: str) -> DataFrame:
    """The group's strict mean on each of its rows."""
    return with_group_value(df, keys, group_mean(df, keys, measure, out))


def with_group_median(df: DataFrame, keys: Sequence[str], measure: str, out: str) -> DataFrame:
    """The group's exact strict median on each of its rows."""
    return with_group_value(df, keys, group_median(df, keys, measure, out))


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows over the columns (all by default)."""
    if columns is None:
        return df.distinct()
    require(df, columns)
    return df.select(*[quoted(c) for c in columns]).distinct()
