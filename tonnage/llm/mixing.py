"""Mixing sources to target weights by systematic sampling.

Every document of a source is due the same number of copies, the source's target over its
size. Lined up by size, the copies due are summed, one random offset is added, and a document
is taken once for each whole number its stretch crosses. As neighbours in line are of about
the same size, the words taken differ from the target by about one document. Of 16 offsets,
evenly spread from a random one, the one that comes nearest to the target is used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tonnage.llm.words import blocks, find_words
from tonnage.sources.staging import stage

WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
MOST_COPIES = 2
SEED = "mix-1"
OFFSETS = 16


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in blocks(batches, "text"):
        first = find_words(texts)[2]
        columns = {c: batch.column(c) for c in ("doc_id", "source", "key")}
        yield pa.record_batch(columns | {"size": pa.array(np.diff(first).astype(np.int64))})


def row_key(docs: DataFrame) -> Column:
    """A 64-bit hash of a document's id, source and text."""
    null = F.array(*[F.col(c).isNull() for c in ("doc_id", "source", "text")])
    return F.xxhash64("doc_id", "source", "text", null)


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, key (see row_key) and the number of words of each row; a null text has none."""
    rows = docs.select("doc_id", "source", row_key(docs).alias("key"), "text")
    return rows.mapInArrow(_sizes, "doc_id long, source string, key long, size long")


def targets(
    totals: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    percent: int = SHARE_PERCENT,
    most: int = MOST_COPIES,
) -> DataFrame:
    """source and source_size with target, its share of percent of all sizes.

    Sources in code-point order, null last, weigh weights in turn. A target stops at most times
    the source's size, and the excess goes to the others by weight. So each target is the lesser
    of its limit and level * weight, where level is the highest of what is left for the others
    per unit of their weight, over all ways to stop those that reach their limit first.
    Windows here run over one row per source.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    by_limit = W.orderBy("per_weight", "number").rowsBetween(W.unboundedPreceding, -1)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("number") % len(weights) + 1).cast("int"))
    number = F.row_number().over(order) - 1
    placed = totals.select("source", "source_size", number.alias("number")).withColumn("weight", weight)
    placed = placed.withColumn("per_weight", most * F.col("source_size") / F.col("weight"))
    stopped = F.coalesce(F.sum(most * F.col("source_size")).over(by_limit), F.lit(0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_limit), F.lit(0))
    budget = F.sum("source_size").over(everything) * (percent / 100)
    levels = placed.withColumn("level", (budget - stopped) / open_weight)
    target = F.least(F.max("level").over(everything) * F.col("weight"), (most * F.col("source_size")).cast("double"))
    return levels.select("source", "source_size", F.round(target, 6).alias("target"))


def offset(source: Column, seed: str, turn: int | Column) -> Column:
    """The offset of a source at a turn of OFFSETS: evenly spread in [0, 1) from a random one, the same in every run."""
    digits = F.substring(F.md5(F.concat(F.lit(seed), F.lit(":"), F.coalesce(source, F.lit("")))), 1, 8)
    start = F.conv(digits, 16, 10).cast("double") / F.lit(4294967296.0) + turn / F.lit(float(OFFSETS))
    return start - F.floor(start)


def _copies(seed: str, turn: int | Column) -> Column:
    """Whole numbers that a row's stretch of copies due crosses, moved by an offset."""
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    start = offset(F.col("source"), seed, turn)
    return (F.floor(F.col("last") * rate + start) - F.floor((F.col("last") - 1) * rate + start)).cast("int")


def _lined(rows: DataFrame, group: str, *order: str, count: str = "1") -> DataFrame:
    """rows, staged, with last: the running total of count within group, lined up by order.

    The range exchange deals any group over as many tasks as its rows need; what comes before a
    task's rows is summed from one row per group and task.
    """
    lined = rows.repartitionByRange(F.col(group).asc_nulls_last(), *order)
    lined = stage(lined.withColumn("part", F.spark_partition_id()))
    earlier = W.partitionBy("of").orderBy("in").rowsBetween(W.unboundedPreceding, -1)
    parts = lined.groupBy(F.col(group).alias("of"), F.col("part").alias("in")).agg(F.sum(F.expr(count)).alias("rows"))
    parts = parts.select("of", "in", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))
    within = W.partitionBy("part", group).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    placed = lined.withColumn("at", F.sum(F.expr(count)).over(within))
    placed = placed.join(parts, F.col(group).eqNullSafe(F.col("of")) & (F.col("part") == F.col("in")))
    return placed.withColumn("last", F.col("before") + F.col("at")).drop("of", "in", "before", "at", "part")


def mixture(docs: DataFrame, seed: str = SEED, **how) -> DataFrame:
    """doc_id, source, key, size, source_size, target and copies of each row of docs.

    copies is how often the mix takes the row, 0 to 2 by default. Null counts as a source of its
    own. Rows of a source line up by size, doc_id and key; equal rows stand next to each other, so
    the result does not depend on how docs is stored. A source without words gets no copies.
    Columns other than doc_id, source and text are ignored.
    """
    # Staged, as the range exchange reads its rows twice: for the bounds and to deal them out.
    sized = stage(sizes(docs))
    goals = stage(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), **how))
    goals = goals.withColumnRenamed("source", "of")
    placed = _lined(sized, "source", "size", "doc_id", "key")
    placed = stage(placed.join(goals, F.col("source").eqNullSafe(F.col("of"))).drop("of"))
    tries = [F.sum(F.col("size") * _copies(seed, F.lit(k))) for k in range(OFFSETS)]
    errors = [F.struct(F.abs(t - F.first("target")).alias("error"), F.lit(k).alias("turn")) for k, t in enumerate(tries)]
    turns = stage(placed.groupBy("source").agg(F.array_min(F.array(*errors))["turn"].alias("turn")))
    turns = turns.withColumnRenamed("source", "of")
    placed = placed.join(turns, F.col("source").eqNullSafe(F.col("of")))
    copies = _copies(seed, F.col("turn")).alias("copies")
    return placed.select("doc_id", "source", "key", "size", "source_size", "target", copies)


def mix(docs: DataFrame, seed: str = SEED, **how) -> DataFrame:
    """docs with all its columns, each row as often as the mixture takes it.

    Rows equal in doc_id, source and text share the copies that the mixture takes of them as evenly
    as whole numbers allow, so the source still meets its target. Any names of columns will do.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    renamed = [F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=True)]
    rows = docs.select(*renamed, row_key(docs).alias("key"))
    taken = mixture(docs, seed, **how).groupBy("key").agg(F.sum("copies").alias("copies"), F.count("*").alias("rows"))
    taken = stage(taken.where("copies > 0"))
    once = rows.join(taken.where("rows = 1").drop("rows"), "key").select(*names, F.col("copies").cast("long"))
    # Rows that are equal in all columns are one row with a number; of the others few share a key.
    # Staged, the keys that come again show their own size, so the planner moves no text to find few or none.
    repeated = stage(taken.where("rows > 1"))
    again = rows.join(repeated.select("key"), "key", "left_semi")
    again = again.groupBy("key", *names).agg(F.count("*").alias("number"))
    again = _lined(again.withColumn("order", F.xxhash64(*names)), "key", "order", count="number")
    again = again.join(repeated, "key")
    upto = "(last * copies) div rows - ((last - number) * copies) div rows"
    both = once.unionByName(again.select(*names, F.expr(upto).alias("copies")).where("copies > 0"))
    both = both.withColumn("turn", F.explode(F.sequence(F.lit(1), "copies")))
    return both.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)])
