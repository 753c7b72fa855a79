"""Quantiles from sketches that are added up."""

import pytest
from helpers import as_dict, plan
from pyspark.sql import functions as F

from tonnage.operators import add_sketches, group_median, quantile_sketches, sketched_quantile
from tonnage.operators.sketches import RANK_ERROR


def test_ranks_lie_within_the_stated_error(spark):
    df = spark.range(0, 300_000, 1, 12).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5)).alias("k"),
        (F.col("id") % 30).alias("month"), F.exp(F.randn(4)).alias("v"),
    )
    df = df.cache()
    months = quantile_sketches(df, ["k", "month"], "v")
    whole = add_sketches(months, ["k"])
    assert as_dict(whole, "n", "k") == as_dict(df.groupBy("k").count(), "count", "k")
    for share in (0.0, 0.1, 0.5, 0.99, 1.0):
        found = sketched_quantile(whole, share, "q").select("k", "q")
        rank = df.join(found, "k").groupBy("k").agg(F.avg((F.col("v") <= F.col("q")).cast("int")).alias("r"))
        assert all(abs(r - share) <= RANK_ERROR for r in as_dict(rank, "r", "k").values())
    df.unpersist()


def test_small_groups_are_exact(frame):
    df = frame([("a", float(v)) for v in range(1, 100)] + [("b", 7.0)], "k string, v double")
    found = as_dict(sketched_quantile(quantile_sketches(df, ["k"], "v"), 0.5, "q"), "q", "k")
    assert found == as_dict(group_median(df, ["k"], "v", "q"), "q", "k") == {"a": 50.0, "b": 7.0}


def test_missing_values(frame):
    df = frame([("a", 1.0), ("a", None), ("b", None), ("b", float("nan")), (None, 3.0), ("c", 4.0)], "k string, v double")
    sketches = add_sketches(quantile_sketches(df, ["k"], "v"), ["k"])
    assert as_dict(sketches, "n_missing", "k") == {"a": 1, "b": 2, None: 0, "c": 0}
    assert as_dict(sketched_quantile(sketches, 0.5, "q"), "q", "k") == {"a": None, "b": None, None: 3.0, "c": 4.0}
    assert as_dict(sketched_quantile(sketches, 0.5, "q", strict=False), "q", "k") == {"a": 1.0, "b": None, None: 3.0, "c": 4.0}
    assert quantile_sketches(frame([], "k string, v double"), ["k"], "v").count() == 0
    with pytest.raises(ValueError, match="between 0 and 1"):
        sketched_quantile(sketches, 1.5, "q")


def test_only_sketches_are_shuffled(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("k"), F.col("id").cast("double").alias("v"))
    assert "partial_kll_sketch_agg_double" in plan(quantile_sketches(df, ["k"], "v"))
