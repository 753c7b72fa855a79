"""Per-capita drivers, log-log projection, capping and interpolation over years."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonnage.functions import if_else, r_divide, r_log, strict_less
from tonnage.operators.aggregate import group_sum
from tonnage.operators.joins import Keys, join_inner, join_left
from tonnage.operators.relational import keep, missing_test, quoted, rename, require
from tonnage.sources.staging import stage


def per_capita(
    amounts: DataFrame,
    population: DataFrame,
    keys: Sequence[str],
    on: Sequence[str],
    measure: str,
    people: str,
    scale: float,
    where: Column,
    out: Sequence[str],
) -> DataFrame:
    """Total per key over population, times `scale`: the distinct rows of `out`.

    `where` tests keys only, so it is applied before the aggregation.
    """
    totals = group_sum(amounts.where(where), keys, measure)
    heads = keep(rename(population, {people: "__people"}), *on, "__people")
    rows = join_left(totals, heads, on)
    ratio = r_divide(quoted(measure), "__people") * scale
    return keep(rows.withColumn(measure, ratio), *out).distinct()


def loglog_project(
    df: DataFrame,
    x: str,
    coefficients: Mapping[str, tuple[float, float]] | DataFrame,
    names_to: str,
    out: str,
    on: Sequence[str] = (),
) -> DataFrame:
    """exp(a + b log x) for each labelled pair (a, b), one row per pair.

    The pairs are given by label, or as a table with columns `names_to`, a and b, such as `fit_line`
    makes, and the keys `on` by which a row of df finds its pairs; without a pair it has no
    row. A table needs such keys: without them every row would meet every pair of a table of any size.
    """
    require(df, [x])
    if isinstance(coefficients, DataFrame):
        if not on:
            raise ValueError("a table of coefficients needs keys to be joined on")
        kept = list(dict.fromkeys([*on, names_to, "a", "b"]))
        pairs = rename(keep(coefficients, *kept), {"a": "__a", "b": "__b"})
        rows, a, b = join_inner(df, pairs, list(on)), F.col("__a"), F.col("__b")
        return rows.withColumn(out, F.exp(a + b * r_log(quoted(x)))).drop("__a", "__b")
    pairs = F.array(
        *[
            F.struct(F.lit(k).alias("k"), F.lit(float(a)).alias("a"), F.lit(float(b)).alias("b"))
            for k, (a, b) in coefficients.items()
        ]
    )
    rows = df.withColumn("__c", F.explode(pairs))
    value = F.exp(F.col("__c.a") + F.col("__c.b") * r_log(quoted(x)))
    return rows.withColumn(names_to, F.col("__c.k")).withColumn(out, value).drop("__c")


def cap_and_hold(
    projected: DataFrame,
    base: DataFrame,
    on: Keys,
    measure: str,
    base_measure: str,
    years: tuple[int, int, int],
) -> DataFrame:
    """Base value, projection capped at it, and the capped value held to the last year.

    One row per year. A missing value on either side, null or NaN, leaves the cap missing.
    """
    base_year, capped_year, held_year = years
    rows = join_left(rename(projected, {measure: "__p"}), rename(base, {base_measure: "__b"}), on)
    capped = if_else(strict_less("__b", "__p"), "__b", "__p")
    points = [(base_year, F.col("__b")), (capped_year, capped), (held_year, capped)]
    cells = [F.struct(F.lit(y).alias("year"), v.alias(measure)) for y, v in points]
    ids = [quoted(c) for c in rows.columns if c not in ("__p", "__b", "year")]
    return rows.select(*ids, F.inline(F.array(*cells)))


def _grid(points: Sequence[float]) -> Column:
    """The points as one literal, however many: a text that Spark takes apart once, when it plans."""
    return F.split(F.lit(" ".join(repr(float(p)) for p in points)), " ").cast("array<double>")


def _points_below(points: Sequence[float], x: Column) -> Column:
    """How many of the ascending points lie below x: a binary search, one step for each bit of their number."""
    grid = _grid(points)
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(len(points).bit_length()))])
    further = lambda at, step: F.when(F.get(grid, at + step - 1) < x, at + step).otherwise(at)
    return F.aggregate(steps, F.lit(0), further)


def _knots(df: DataFrame, group: Sequence[str], x: str, y: str) -> DataFrame:
    """The group columns, __x and __y of each point: the mean of the known y at one x.

    A group without a known point has one row without __x.
    """
    by = [quoted(g) for g in group]
    known = ~(missing_test(df, x) | missing_test(df, y))
    return (
        df.select(*by, F.when(known, quoted(x).cast("double")).alias("__x"), quoted(y).alias("__y"))
        .groupBy(*by, "__x")
        .agg(F.avg(F.when(F.col("__x").isNotNull(), F.col("__y"))).alias("__y"))
    )


def interpolate_at(df: DataFrame, group: Sequence[str], x: str, y: str, points: DataFrame) -> DataFrame:
    """Linear interpolation of y along x at each group's own points: the columns group and x of points.

    The rules are those of `interpolate`, but the points are rows of a table, as many and as
    different from group to group as need be. Each distinct one comes back; a missing x gives null.
    Knots and points are lined up by group and x and cut into ranges, which are staged; a group of any
    length so lies in many ranges, each a task of its own. The last knot before and the first knot
    after a range are carried over from a table with a row per group and range.
    """
    require(df, [*group, x, y])
    require(points, [*group, x])
    by = [quoted(g) for g in group]
    kind = points.schema[x].dataType
    at = quoted(x).cast("double")
    asked = points.select(*by, at.alias("__x")).distinct().withColumns({"__y": F.lit(None).cast("double"), "__asked": F.lit(1)})
    knots = _knots(df, group, x, y).where(F.col("__x").isNotNull()).withColumn("__asked", F.lit(0))
    lined = knots.unionByName(asked).repartitionByRange(*by, "__x").withColumn("__range", F.spark_partition_id())
    lined = stage(lined)
    knot = F.when(F.col("__asked") == 0, F.struct("__x", "__y"))
    ends = lined.groupBy(*by, "__range").agg(
        F.count(knot).alias("__n"), F.min(knot).alias("__first"), F.max(knot).alias("__last")
    )
    ranges, whole = Window.partitionBy(*by).orderBy("__range"), Window.partitionBy(*by)
    back = Window.partitionBy(*by).orderBy(F.desc("__range"))
    carried = ends.select(
        *by, "__range",
        F.last("__last", True).over(ranges.rowsBetween(Window.unboundedPreceding, -1)).alias("__before"),
        F.last("__first", True).over(back.rowsBetween(Window.unboundedPreceding, -1)).alias("__after"),
        (F.sum("__n").over(whole) >= 2).alias("__enough"),
    )
    # Looking ahead is looking back in the other direction, which takes one pass where a frame
    # that ends with the partition would take one for each row. A knot stands before a point at its x.
    part = Window.partitionBy(*by, "__range")
    up = part.orderBy("__x", "__asked").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    down = part.orderBy(F.desc("__x"), F.desc("__asked")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = lined.select(*by, "__range", "__x", "__asked", F.last(knot, True).over(up).alias("__p"), F.last(knot, True).over(down).alias("__q"))
    rows = join_left(near.where(F.col("__asked") == 1), carried, [*group, "__range"])
    before, after = F.coalesce("__p", "__before"), F.coalesce("__q", "__after")
    rows = rows.withColumns({"__p": before, "__q": after})
    x1, y1, x2, y2 = (F.col(c) for c in ("__p.__x", "__p.__y", "__q.__x", "__q.__y"))
    between = y1 + (y2 - y1) * ((F.col("__x") - x1) / (x2 - x1))
    value = F.when(x1 == F.col("__x"), y1).when(x2 > x1, between)
    return rows.select(*by, F.col("__x").cast(kind).alias(x), F.when(F.col("__enough"), value).alias(y))


def interpolate(
    df: DataFrame, group: Sequence[str], x: str, y: str, grid: Sequence[float] | DataFrame
) -> DataFrame:
    """Linear interpolation of y along x at the grid points of every group.

    The grid is a list for all groups, or a table of each group's own points (see `interpolate_at`).

    Known points are kept, points outside the known range are null, and so is every
    point of a group with fewer than two known points. Several y at one x are
    averaged first.

    The knots between two neighbouring grid points matter only through their first
    and last, so each group shrinks to at most one row per grid interval before any
    task sees the group as a whole.
    """
    if isinstance(grid, DataFrame):
        return interpolate_at(df, group, x, y, grid)
    require(df, [*group, x, y])
    points = sorted(set(grid))
    by = [quoted(g) for g in group]
    kind = df.schema[x].dataType
    knots = _knots(df, group, x, y)
    grid_x = _grid(points)
    passed = _points_below(points, F.col("__x"))
    # Interval i holds the knots after i grid points; -1 marks a group without knots.
    interval = F.when(F.col("__x").isNull(), F.lit(-1)).otherwise(passed)
    ends = knots.groupBy(*by, interval.alias("__i")).agg(
        F.min("__x").alias("__x0"),
        F.min_by("__y", "__x").alias("__y0"),
        F.max("__x").alias("__x1"),
        F.max_by("__y", "__x").alias("__y1"),
        F.count("__x").alias("__n"),
    )
    along = Window.partitionBy(*by).orderBy("__i")
    whole = Window.partitionBy(*by)
    spans = ends.select(
        *by,
        "__i",
        "__x1",
        "__y1",
        F.lead("__x0").over(along).alias("__x2"),
        F.lead("__y0").over(along).alias("__y2"),
        F.when(F.row_number().over(along) == 1, 0).otherwise(F.col("__i")).alias("__from"),
        (F.coalesce(F.lead("__i").over(along), F.lit(len(points))) - 1).alias("__to"),
        (F.sum("__n").over(whole) >= 2).alias("__enough"),
    )
    covered = F.when(F.col("__from") <= F.col("__to"), F.sequence("__from", "__to"))
    cells = spans.withColumn("__j", F.explode(covered))
    at = F.element_at(grid_x, F.col("__j") + 1)
    slope = (F.col("__y2") - F.col("__y1")) * ((at - F.col("__x1")) / (F.col("__x2") - F.col("__x1")))
    value = F.when(at == F.col("__x1"), F.col("__y1")).otherwise(F.col("__y1") + slope)
    inside = F.col("__enough") & (F.col("__j") >= F.col("__i"))
    return cells.select(*by, at.cast(kind).alias(x), F.when(inside, value).alias(y))
