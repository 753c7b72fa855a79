"""Pricing, scaling to the median and the checked residual."""

import pytest
from helpers import as_dict, rows

from tonnage.operators import keep, median_scalar, price, residual, scale_by


def test_price_joins_on_a_differently_named_key(frame):
    df = frame([("steel", 2020, 2.0), ("copper", 2020, 1.0), ("tin", 2020, 1.0)], "m string, year int, v double")
    prices = frame([("steel", 2020, 0.5), ("copper", 2020, None)], "resource string, year int, p double")
    got = price(df, prices, {"m": "resource", "year": "year"}, "v", "p", 0.13, 1.0, "cost")
    assert as_dict(got, "cost", "m") == {"steel": pytest.approx(0.13), "copper": None, "tin": None}


def test_median_scalar_has_median_one(frame):
    df = frame([("a", 2020, 1.0), ("b", 2020, 2.0), ("c", 2020, 6.0), ("a", 2025, 0.0), ("b", 2025, 0.0)],
               "r string, year int, cost double")
    got = median_scalar(df, ["year"], "cost")
    assert got.columns == ["r", "year", "cost", "avg_cost", "median_cost", "scalar"]
    assert {r.r: r.scalar for r in got.where("year = 2020").collect()} == {"a": 0.5, "b": 1.0, "c": 3.0}
    assert {r.avg_cost for r in got.where("year = 2020").collect()} == {3.0}
    assert all(r.scalar != r.scalar for r in got.where("year = 2025").collect())


def test_scale_by_fans_out(frame):
    scalars = frame([("a", 2020, 0.5), ("b", 2020, 2.0)], "r string, year int, scalar double")
    base = frame([("s1", 2020, 10.0), ("s2", 2020, 20.0), ("s1", 2025, 1.0)], "s string, year int, cost double")
    got = keep(scale_by(scalars, base, ["year"], "cost"), "r", "s", "cost")
    assert rows(got) == [("a", "s1", 5.0), ("a", "s2", 10.0), ("b", "s1", 20.0), ("b", "s2", 40.0)]


def test_residual(frame):
    total = frame([("a", "s1", 5.0), ("a", "s2", 7.0)], "r string, s string, cost double")
    part = frame([("a", 1.5)], "r string, mineral double")
    assert rows(residual(total, part, ["r"], "cost", "mineral")) == [("a", "s1", 3.5), ("a", "s2", 5.5)]
    with pytest.raises(Exception, match="no match, or no value"):
        residual(total, frame([("b", 1.0)], "r string, mineral double"), ["r"], "cost", "mineral").collect()
    unknown = frame([("a", "s1", None)], "r string, s string, cost double")
    assert rows(residual(unknown, part, ["r"], "cost", "mineral")) == [("a", "s1", None)]
    for lost in ([("b", 1.0)], [("a", None)], [("a", float("nan"))]):
        with pytest.raises(Exception, match="no match, or no value"):
            residual(unknown, frame(lost, "r string, mineral double"), ["r"], "cost", "mineral").collect()
    with pytest.raises(Exception, match="more than once"):
        residual(total, part.unionByName(part), ["r"], "cost", "mineral").collect()
