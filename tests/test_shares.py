"""Shares, splits and allocations against hand-computed rows."""

import pytest
from helpers import as_dict, cell, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tonnage.operators import (
    allocate,
    child_shares,
    discard,
    keep,
    rollup_sum,
    share_of_total,
    split_by_fractions,
    split_by_percent,
    split_by_share,
    tidy_measures,
    weighted_rollup,
)


def test_tidy_measures(frame):
    stock = frame(
        [("A", "1000", "2"), ("B", "3", "-"), ("A", "1,234", "1,5"), ("Gone", "-", "-"), ("Total", "9", "9"),
         ("Nowhere", "1", "1")],
        "country string, p string, q string",
    )
    places = frame([("A", "X"), ("B", "X"), ("Gone", "Y")], "country string, region string")
    got = tidy_measures(stock, ["p", "q"], "system", places, {"country": "Total"})
    assert rows(got) == [("A", "p", 1000.0, "X"), ("A", "q", 2.0, "X"), ("B", "p", 3.0, "X")]
    assert got.columns == ["country", "system", "value", "region"]


def test_share_of_total_with_zero_null_and_null_group(frame):
    df = frame(
        [("a", 1.0), ("a", 3.0), ("z", 0.0), ("n", 1.0), ("n", None), (None, 5.0)],
        "k string, x double",
    )
    got = {(r.k, r.x): cell(r.share) for r in share_of_total(df, ["k"], "x").collect()}
    assert got == {
        ("a", 1.0): 0.25, ("a", 3.0): 0.75, ("z", 0.0): "nan", ("n", 1.0): None, ("n", None): None,
        (None, 5.0): 1.0,
    }


AMOUNTS = st.lists(st.tuples(st.sampled_from("abc"), st.integers(1, 50).map(float)), min_size=1, max_size=12)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(AMOUNTS)
def test_shares_sum_to_one_and_splits_conserve_the_total(spark, amounts):
    df = spark.createDataFrame([(k, i, x) for i, (k, x) in enumerate(amounts)], "k string, i int, x double")
    shares = share_of_total(df, ["k"], "x")
    for total in as_dict(shares.groupBy("k").agg(F.sum("share").alias("s")), "s", "k").values():
        assert total == pytest.approx(1.0)
    parents = spark.createDataFrame([(k, 10.0 + ord(k)) for k in {k for k, _ in amounts}], "k string, v double")
    split = split_by_share(parents, keep(shares, "k", "i", "share"), ["k"], "v")
    sums = as_dict(split.groupBy("k").agg(F.sum("v").alias("s")), "s", "k")
    assert sums == {k: pytest.approx(10.0 + ord(k)) for k in sums}
    back = allocate(parents, keep(shares, "k", "i", "share"), ["k"], "v")
    sums = as_dict(back.groupBy("k").agg(F.sum("v").alias("s")), "s", "k")
    assert sums == {k: pytest.approx(10.0 + ord(k)) for k in sums}


def test_split_by_share_keeps_both_sides(frame):
    parents = frame([("c1", "X", 10.0), ("c2", "X", 20.0), ("c3", "Y", 5.0)], "c string, r string, v double")
    shares = frame([("X", "t1", 0.25), ("X", "t2", 0.75), ("Z", "t1", 1.0)], "r string, t string, share double")
    assert rows(keep(split_by_share(parents, shares, ["r"], "v"), "c", "r", "t", "v")) == [
        (None, "Z", "t1", None),
        ("c1", "X", "t1", 2.5), ("c1", "X", "t2", 7.5), ("c2", "X", "t1", 5.0), ("c2", "X", "t2", 15.0),
        ("c3", "Y", None, None),
    ]


def test_split_by_fractions(frame):
    df = frame([("a", "X", 100.0), ("b", "Y", 100.0), ("c", "W", 100.0)], "c string, r string, v double")
    lookup = frame([("X", 50.0), ("Y", None)], "r string, pct double")
    got = split_by_fractions(df, "v", ("low", 0.63), ("cable", "over"), lookup, ["r"], "pct", "part")
    values = {(r.c, r.part): r.v for r in got.collect()}
    assert got.columns == ["c", "r", "part", "v"]
    assert values == {
        ("a", "low"): 63.0, ("a", "cable"): 18.5, ("a", "over"): 18.5,
        ("b", "low"): 63.0, ("b", "cable"): 0.0, ("b", "over"): 37.0,
        ("c", "low"): 63.0, ("c", "cable"): 0.0, ("c", "over"): 37.0,
    }


def test_split_by_percent(frame):
    df = frame([("X", "High", 10.0), ("X", "Low", 20.0), ("Y", "High", 4.0)], "r string, cls string, v double")
    percents = frame([("X", 10.0, 50.0), ("Y", 25.0, None)], "r string, ph double, pl double")
    classes = {"High": ("ph", "HV over", "HV under"), "Low": ("pl", "LV over", "LV under")}
    got = split_by_percent(df, ["r"], classes, "cls", "v", percents, "part")
    assert rows(got) == [
        ("X", "HV over", 9.0), ("X", "HV under", 1.0), ("X", "LV over", 10.0), ("X", "LV under", 10.0),
        ("Y", "HV over", 3.0), ("Y", "HV under", 1.0), ("Y", "LV over", None), ("Y", "LV under", None),
    ]
    with pytest.raises(Exception, match="two rows for one cell"):
        split_by_percent(df.unionByName(df), ["r"], classes, "cls", "v", percents, "part").collect()


def test_weighted_rollup_does_not_renormalise(frame):
    capacity = frame([("a", 1.0), ("b", 3.0), ("c", 5.0), ("lost", 9.0)], "c string, gw double")
    places = frame([("a", "X"), ("b", "X"), ("c", "Y")], "c string, r string")
    shares = child_shares(capacity, places, ["c"], "r", "gw")
    assert as_dict(shares, "share", "c") == {"a": 0.25, "b": 0.75, "c": 1.0}
    values = frame([("a", "steel", 8.0), ("c", "steel", 2.0)], "c string, m string, v double")
    got = weighted_rollup(values, shares, ["c"], ["r", "m"], "v")
    assert as_dict(got, "v", "r", "m") == {("X", "steel"): 2.0, ("Y", "steel"): 2.0}


def test_allocate_is_many_to_many(frame):
    shares = frame([("a", "X", 0.25), ("b", "X", 0.75), ("c", "Y", 1.0)], "c string, r string, share double")
    totals = frame([("X", "steel", 8.0), ("X", "copper", 4.0)], "r string, m string, v double")
    got = discard(allocate(totals, shares, ["r"], "v"), "share", "r")
    assert rows(got) == [
        ("a", "copper", 1.0), ("a", "steel", 2.0), ("b", "copper", 3.0), ("b", "steel", 6.0), ("c", None, None),
    ]


def test_rollup_sum_stacks_and_sums_by_level(frame):
    one = frame([("a", "t", 1.0, "x"), ("a", "d", 2.0, "y")], "c string, s string, v double, extra string")
    two = frame([("a", "t", 4.0), ("b", "t", None)], "c string, s string, v double")
    assert rows(rollup_sum([one, two], [["c", "s"], ["c"]], "v")) == [("a", 7.0), ("b", None)]
