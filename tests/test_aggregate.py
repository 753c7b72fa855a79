"""Grouped aggregates, above all the exact median on large groups."""

import statistics

import pytest
from helpers import as_dict, plan, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tonnage.operators import (
    group_mean,
    group_median,
    group_sum,
    share_of_total,
    with_group_mean,
    with_group_median,
)

NAN = float("nan")


def test_sum_and_mean_by_group(frame):
    df = frame([("a", 1.0), ("a", 3.0), (None, 5.0), ("b", None)], "k string, x double")
    assert as_dict(group_sum(df, ["k"], "x"), "x", "k") == {"a": 4.0, None: 5.0, "b": None}
    assert as_dict(group_mean(df, ["k"], "x", "m"), "m", "k") == {"a": 2.0, None: 5.0, "b": None}


def test_median_of_odd_even_and_missing(frame):
    df = frame(
        [("odd", 3.0), ("odd", 1.0), ("odd", 2.0), ("even", 1.0), ("even", 4.0), ("one", 7.0),
         ("null", 1.0), ("null", None), ("nan", 1.0), ("nan", NAN), (None, 2.0)],
        "k string, x double",
    )
    assert as_dict(group_median(df, ["k"], "x"), "median", "k") == {
        "odd": 2.0, "even": 2.5, "one": 7.0, "null": None, "nan": None, None: 2.0,
    }


VALUES = st.lists(
    st.tuples(st.sampled_from("ab"), st.integers(-3, 3).map(float)), min_size=1, max_size=30
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(VALUES)
def test_median_against_brute_force(spark, values):
    df = spark.createDataFrame(values, "k string, x double")
    want = {
        k: statistics.median([x for g, x in values if g == k]) for k in {g for g, _ in values}
    }
    assert as_dict(group_median(df, ["k"], "x"), "median", "k") == want


@pytest.mark.parametrize("reach", [0.0, -0.4, 0.5])
def test_median_does_not_depend_on_the_bracket(spark, reach):
    """Also when the bracket misses the median, or holds all values."""
    df = spark.range(5001).select(
        (F.col("id") % 4).alias("k"), ((F.col("id") * 37) % 1009).cast("double").alias("x")
    )
    got = as_dict(group_median(df, ["k"], "x", reach=reach), "median", "k")
    assert got == as_dict(df.groupBy("k").agg(F.median("x").alias("m")), "m", "k")


def test_median_of_a_group_that_spans_many_chunks(spark, conf):
    """One group holds most rows and its values lie in many range partitions."""
    conf(
        spark__sql__shuffle__partitions="12",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    hot = F.when(F.col("id") % 10 < 7, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 3))
    df = spark.range(40_001).select(hot.alias("k"), ((F.col("id") * 7919) % 9973).cast("double").alias("x"))
    got = as_dict(group_median(df, ["k"], "x"), "median", "k")
    assert got == as_dict(df.groupBy("k").agg(F.median("x").alias("m")), "m", "k")
    assert len(got) == 4


def test_group_values_on_every_row(frame):
    df = frame([("a", 1.0), ("a", 2.0), ("a", 9.0), ("b", 4.0)], "k string, x double")
    assert rows(with_group_mean(df, ["k"], "x", "m")) == [
        ("a", 1.0, 4.0), ("a", 2.0, 4.0), ("a", 9.0, 4.0), ("b", 4.0, 4.0),
    ]
    assert rows(with_group_median(df, ["k"], "x", "m")) == [
        ("a", 1.0, 2.0), ("a", 2.0, 2.0), ("a", 9.0, 2.0), ("b", 4.0, 4.0),
    ]


def test_rows_stay_in_place_when_a_group_value_is_attached(frame):
    """No exchange of the rows themselves, whatever the size of a group."""
    df = frame([("a", 1.0), ("a", 3.0)], "k string, x double")
    shares = share_of_total(df, ["k"], "x")
    assert rows(shares) == [("a", 1.0, 0.25), ("a", 3.0, 0.75)]
    text = plan(shares)
    assert "BroadcastHashJoin" in text
    assert "hashpartitioning" not in text


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_result_does_not_depend_on_partitioning(spark, parts):
    df = spark.range(1000).select(
        (F.col("id") % 7).alias("k"), (F.col("id") % 97).cast("double").alias("x")
    )
    got = as_dict(group_median(df.repartition(parts), ["k"], "x"), "median", "k")
    assert got == as_dict(df.groupBy("k").agg(F.median("x").alias("m")), "m", "k")
