"""Factors over several steps, and rows in units of their own."""

import math

import pytest
from helpers import as_dict
from pyspark.sql import functions as F

from tonnage.functions import FACTORS, factor, factors_to, unit_path
from tonnage.operators import convert_to


def test_paths_multiply_factors():
    assert unit_path("EJ", "kWh") == ["EJ", "GJ", "kWh"]
    assert factor("EJ", "kWh") == pytest.approx(1e9 / 3.6e-3)
    assert factor("kWh", "EJ") == 3.6e-12
    assert factor("TWh", "MWh") == pytest.approx(1e6)
    assert factor("g", "Gg") == pytest.approx(1e-9)
    assert factor("GW", "kWh/year") == 8.76e9
    assert factor("bbl RFO", "GJ") == pytest.approx(40.87 / 6.66)
    assert factor("year", "h") == 8766 and factor("t", "t") == 1.0


def test_parts_of_a_unit():
    assert factor("kg/kW", "Mt/GW") == pytest.approx(1e-3)
    assert factor("Mt/EJ", "kg/kWh") == pytest.approx(1e9 * 3.6e-12)
    assert factor("kg/m2/year", "t/ha/day") == pytest.approx(1e-3 * 1e4 / 365.25)
    # Listed as a whole, so not taken apart.
    assert factor("kWh/year", "kW") == pytest.approx(1 / 8760)


def test_there_and_back_for_every_pair():
    for unit in {u for pair in FACTORS for u in pair}:
        for other, f in factors_to(unit).items():
            assert f * factor(unit, other) == pytest.approx(1.0)
    for (a, b), f in FACTORS.items():
        assert factor(a, b) == f


def test_ways_round_agree():
    """Where the listed factors make a circle, both ways lead to nearly the same."""
    for (a, b), f in FACTORS.items():
        for c in factors_to(a):
            assert factor(a, c) == pytest.approx(f * factor(b, c), rel=1e-3)


def test_units_of_different_things():
    for a, b in (("t", "GJ"), ("kg/kW", "kg/t"), ("ha", "m3"), ("kW", "kWh")):
        with pytest.raises(ValueError, match="different things"):
            factor(a, b)
    for a, b in (("stone", "kg"), ("kg", "kg/kW"), ("", "kg")):
        with pytest.raises(ValueError, match="no factor"):
            factor(a, b)


def test_rows_in_their_own_units(frame):
    df = frame([("a", "EJ", 2.0), ("b", "kWh", 5.0), ("c", "GJ", 1.5), ("d", None, 3.0), ("e", "TBtu", None), ("f", "GJ", math.inf)], "k string, unit string, v double")
    found = convert_to(df, "v", "GJ")
    assert as_dict(found, "v", "k") == {"a": 2e9, "b": pytest.approx(0.018), "c": 1.5, "d": None, "e": None, "f": math.inf}
    assert as_dict(found, "unit", "k") == {"a": "GJ", "b": "GJ", "c": "GJ", "d": None, "e": "GJ", "f": "GJ"}


def test_a_row_in_another_unit_stops_the_job(frame):
    df = frame([("a", "GJ", 1.0), ("b", "kg", 2.0)], "k string, unit string, v double")
    with pytest.raises(Exception, match="no factor to GJ for a row in kg"):
        convert_to(df, "v", "GJ").collect()
    assert as_dict(convert_to(df, "v", "GJ", strict=False), "v", "k") == {"a": 1.0, "b": None}
    assert convert_to(df.where(F.col("unit") == "GJ"), "v", "GJ").count() == 1
    with pytest.raises(ValueError, match="different things"):
        convert_to(df, "v", "GJ", also=["kg"])
    with pytest.raises(ValueError, match="no factor"):
        convert_to(df, "v", "stone")
