"""Missing values, division, logarithm and text rules of the column functions."""

import math

import pytest
from helpers import as_dict, cell
from pyspark.sql import functions as F

from tonnage.functions import (
    FACTORS,
    MODEL_YEARS,
    factor,
    if_else,
    is_in,
    is_missing,
    label,
    not_in,
    parse_grouped,
    piece,
    r_divide,
    r_log,
    recode,
    strict_less,
    strict_mean,
    strict_sum,
    to_number,
    zero_if_missing,
)
from tonnage.functions.units import FULL_LOAD_HOURS

INF, NAN = float("inf"), float("nan")


def test_strict_aggregates_are_null_when_one_value_is(frame):
    df = frame(
        [("a", 1.0), ("a", 2.0), ("b", 1.0), ("b", None), ("c", NAN), ("c", 1.0), (None, 4.0)],
        "k string, x double",
    )
    out = df.groupBy("k").agg(strict_sum("x").alias("s"), strict_mean("x").alias("m"))
    assert {k: cell(v) for k, v in as_dict(out, "s", "k").items()} == {
        "a": 3.0, "b": None, "c": "nan", None: 4.0,
    }
    assert as_dict(out, "m", "k")["a"] == 1.5
    assert as_dict(out, "m", "k")["b"] is None


@pytest.mark.parametrize(
    ("x", "y", "want"),
    [
        (1.0, 0.0, INF), (-1.0, 0.0, -INF), (0.0, 0.0, "nan"), (NAN, 0.0, "nan"),
        (1.0, -0.0, -INF), (None, 0.0, None), (1.0, None, None), (6.0, 4.0, 1.5),
        (1.0, NAN, "nan"), (INF, 2.0, INF), (1.0, INF, 0.0),
    ],
)
def test_division(frame, x, y, want):
    df = frame([(x, y)], "x double, y double")
    assert cell(df.select(r_divide("x", "y")).first()[0]) == want


def test_logarithm(frame):
    df = frame([(0.0,), (-1.0,), (None,), (NAN,), (math.e,)], "x double")
    got = [cell(r[0]) for r in df.select(r_log("x")).collect()]
    assert got == [-INF, "nan", None, "nan", 1.0]


def test_choice_is_null_when_condition_is_unknown(frame):
    df = frame([(1.0, 2.0), (2.0, 1.0), (None, 1.0), (1.0, None)], "a double, b double")
    got = [r[0] for r in df.select(if_else(F.col("a") < F.col("b"), "a", "b")).collect()]
    assert got == [1.0, 1.0, None, None]


def test_membership_of_null_is_false(frame):
    df = frame([("a",), ("b",), (None,)], "s string")
    assert [r.s for r in df.where(is_in("s", ["a"])).collect()] == ["a"]
    assert [r.s for r in df.where(not_in("s", ["a"])).collect()] == ["b", None]


def test_negated_conjunction_with_null(frame):
    df = frame([(None, "x"), (None, "y"), ("a", "x"), ("b", "x")], "p string, q string")
    kept = df.where(~((F.col("p") == "a") & (F.col("q") == "x"))).collect()
    assert [tuple(r) for r in kept] == [(None, "y"), ("b", "x")]


def test_label_spells_missing(frame):
    df = frame([("HV", "unit"), (None, "unit"), ("HV", None)], "a string, b string")
    got = [r[0] for r in df.select(label("a", "b", sep=" ")).collect()]
    assert got == ["HV unit", "NA unit", "HV NA"]


def test_numbers_from_text(frame):
    texts = ["6,347", "-", "0.00008", "", None, "1,234,567.5", "1,5", "1d", "2f", " 7 ", "1e3", "-.5", "12,34", "0x1", "Inf", "1_0"]
    df = frame([(t,) for t in texts], "s string")
    grouped, plain = zip(*[(cell(a), cell(b)) for a, b in df.select(parse_grouped("s"), to_number("s")).collect()])
    assert plain == (None, None, 0.00008, None, None, None, None, None, None, 7.0, 1000.0, -0.5, None, None, float("inf"), None)
    assert grouped == (6347.0, None, 0.00008, None, None, 1234567.5, None, None, None, 7.0, 1000.0, -0.5, None, None, float("inf"), None)


def test_strict_less(frame):
    df = frame([(1.0, 2.0), (2.0, 1.0), (NAN, 1.0), (1.0, NAN), (None, 1.0), (1.0, None)], "x double, y double")
    assert [r[0] for r in df.select(strict_less("x", "y")).collect()] == [True, False, None, None, None, None]


def test_recode_without_default(frame):
    df = frame([("High",), ("Low",), ("x",), (None,)], "s string")
    got = [r[0] for r in df.select(recode("s", {"High": "HV", "Low": "LV"})).collect()]
    assert got == ["HV", "LV", None, None]


def test_missing_and_default(frame):
    df = frame([(None,), (NAN,), (2.0,)], "x double")
    got = [tuple(r) for r in df.select(is_missing("x"), zero_if_missing("x")).collect()]
    assert got == [(True, 0.0), (True, 0.0), (False, 2.0)]


def test_piece_of_a_name(frame):
    df = frame([("value.2050",), ("value",), (None,)], "s string")
    got = [r[0] for r in df.select(piece("s", r"\.", 2)).collect()]
    assert got == ["2050", None, None]


def test_units_and_years():
    assert factor("kWh", "GJ") * factor("GJ", "EJ") == pytest.approx(3.6e-12)
    assert factor("t", "Mt") * factor("kg", "t") * factor("EJ", "GJ") == pytest.approx(1.0)
    for (a, b), f in FACTORS.items():
        assert (b, a) not in FACTORS
        assert factor(a, b) == f and f * factor(b, a) == pytest.approx(1.0)
    assert factor("kW", "kWh/year") == FULL_LOAD_HOURS
    assert MODEL_YEARS[:3] == (2015, 2020, 2025)
    assert MODEL_YEARS[-1] == 2100
    assert len(MODEL_YEARS) == 18
