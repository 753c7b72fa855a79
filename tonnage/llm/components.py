"""Connected components of an edge list by alternating stars, with all state in staged tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonnage.sources.staging import stage


def _least_neighbour(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the node's least neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    joined = both.join(_least_neighbour(both), "a").where("b > a")
    return joined.select(F.col("b").alias("a"), F.col("least").alias("b")).where("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    joined = down.join(_least_neighbour(down), "a")
    below = joined.select(F.col("b").alias("a"), F.col("least").alias("b"))
    own = joined.select("a", F.col("least").alias("b"))
    return below.unionByName(own).where("a != b").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, component) for all nodes of edges (a, b); component is the least node reachable.

    Each round halves the height of what is left, so few rounds are needed. Rounds aggregate
    before they shuffle, and a node with many neighbours is one row on the joined side.
    """
    edges = stage(edges.where("a != b").select("a", "b").distinct())
    state = _state(edges)
    while True:
        edges = stage(_small_star(_large_star(edges)))
        before, state = state, _state(edges)
        if state == before:
            break
    tops = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        tops.withColumn("component", F.col("node"))
    )
