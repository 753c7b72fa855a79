"""Coefficients, ratios, unit chains and source blending."""

import pytest
from helpers import as_dict, cell, rows
from pyspark.sql import functions as F

from tonnage.functions import if_else
from tonnage.operators import (
    apply_coefficients,
    blend,
    compare_sources,
    convert,
    derive_units,
    keep,
    longer,
    ratio_to,
    recode_and_sum,
    source_differences,
    sum_components,
)

INF = float("inf")


def test_sum_components_keeps_labels_that_differ_by_a_space_apart(frame):
    df = frame(
        [("t", "pylon", ">750 kV", 1.0), ("t", "wire", "> 750 kV", 2.0), ("t", "pylon", "<=220", 3.0),
         ("t", "wire", "<=220", 4.0), ("t", "transformer", None, 9.0)],
        "s string, c string, line string, x double",
    )
    got = sum_components(df, ["s", "line"], "x", "line")
    assert as_dict(got, "x", "line") == {">750 kV": 1.0, "> 750 kV": 2.0, "<=220": 7.0}


def test_apply_coefficients(frame):
    stock = frame([("a", "l1", 10.0), ("a", "l2", 5.0), ("b", "l1", None)], "c string, line string, v double")
    coefs = frame([("l1", "steel", 2.0, "t/km"), ("l1", "copper", 1.0, "t/km")],
                  "line string, m string, x double, unit string")
    got = apply_coefficients(stock, coefs, ["line"], "v", "x", "tons")
    assert rows(keep(got, "c", "line", "m", "v", "unit")) == [
        ("a", "l1", "copper", 10.0, "tons"), ("a", "l1", "steel", 20.0, "tons"),
    ]
    everything = apply_coefficients(stock, coefs, ["line"], "v", "x", "kg", complete=False)
    assert everything.count() == 5
    assert everything.where("m is null").first().v is None


def test_recode_and_sum(frame):
    df = frame([("a", "dt", 1.0), ("a", "tt", 2.0), ("a", "gt", 4.0), ("a", None, 8.0)],
               "c string, s string, v double")
    new = if_else(F.col("s") == "dt", F.lit("d"), F.lit("t"))
    got = recode_and_sum(df, "s", new, ["c", "s"], "v")
    assert as_dict(got, "v", "s") == {"d": 1.0, "t": 6.0, None: 8.0}


def test_ratio_to(frame):
    df = frame([("a", 10.0), ("b", 0.0), ("c", 1.0), ("d", 1.0)], "c string, v double")
    base = frame([("a", 2.0), ("b", 0.0), ("c", 0.0)], "c string, gw double")
    got = {r.c: cell(r.v) for r in ratio_to(df, base, ["c"], "v", "gw", "t/GW").collect()}
    assert got == {"a": 5.0, "c": INF}
    loose = ratio_to(df, base, ["c"], "v", "gw", "kg/kW", 10.0**6, complete=False)
    assert {r.c: cell(r.v) for r in loose.collect()} == {"a": 5e-6, "b": "nan", "c": INF, "d": None}
    assert {r.unit for r in loose.collect()} == {"kg/kW"}
    with pytest.raises(ValueError, match="rename"):
        ratio_to(df, df, ["c"], "v", "v", "x")


def test_derive_units(frame):
    km = frame([("X", "High", 100.0), ("X", "Odd", 1.0)], "r string, cls string, v double")
    per = frame([("High", "substation", 0.5), ("High", "transformer", 0.25)], "cls string, unit string, n double")
    got = derive_units(km, per, ["cls"], "v", "n", "cls", {"High": "HV"}, "unit", "component")
    assert as_dict(got, "v", "component") == {"HV substation": 50.0, "HV transformer": 25.0, "NA NA": None}


def test_convert(frame):
    df = frame([(1.0,)], "v double")
    steps = [("*", 1e-3), ("*", 1e-6), ("/", 8760.0), ("/", 3.6e-3 * 1e-9)]
    assert convert(df, "v", steps).first().v == pytest.approx(0.0317097919837646)
    assert convert(df, "v", steps, "w").columns == ["v", "w"]
    with pytest.raises(ValueError, match="step"):
        convert(df, "v", [("+", 1.0)])


def test_compare_sources_inverts_to_the_long_form(frame):
    df = frame([("X", "K", 1.0), ("X", "D", 2.0), ("Y", "K", 3.0)], "r string, source string, v double")
    wide = compare_sources(df, "source", ["K", "D"], "v")
    assert rows(wide) == [("X", 1.0, 2.0), ("Y", 3.0, None)]
    back = longer(wide, ["K", "D"], "source", "v").na.drop("any")
    assert rows(keep(back, "r", "source", "v")) == rows(df)


def test_blend_leaves_out_one_pair_only(frame):
    df = frame(
        [("X", "steel", "K", 1.0), ("X", "steel", "D", 3.0), ("X", "copper", "K", 5.0),
         ("X", "copper", "D", 100.0), ("Y", "copper", "D", 7.0), ("Y", "steel", "K", None),
         ("Y", "steel", "D", 1.0)],
        "r string, m string, source string, v double",
    )
    got = blend(df, {"source": "D", "m": "copper"}, ["r", "m"], "v", 2015)
    assert rows(got) == [("X", "copper", 5.0, 2015), ("X", "steel", 2.0, 2015), ("Y", "steel", None, 2015)]


def test_differences_of_sources_found_in_the_data(frame):
    df = frame(
        [("X", "K", 2.0), ("X", "D", 3.0), ("X", "E", 0.0), ("Y", "K", 4.0), ("Y", "D", None), (None, "E", 5.0)],
        "r string, source string, v double",
    )
    got = rows(source_differences(df, "source", "v"))
    assert got == rows(frame(
        [("X", "D", "E", 3.0, 0.0, -3.0, 0.0), ("X", "D", "K", 3.0, 2.0, -1.0, 2 / 3), ("X", "E", "K", 0.0, 2.0, 2.0, INF),
         ("Y", "D", "E", None, None, None, None), ("Y", "D", "K", None, 4.0, None, None), ("Y", "E", "K", None, 4.0, None, None),
         (None, "D", "E", None, 5.0, None, None), (None, "D", "K", None, None, None, None), (None, "E", "K", 5.0, None, None, None)],
        "r string, a string, b string, x double, y double, d double, q double",
    ))
    assert source_differences(df.where("source = 'K'"), "source", "v").collect() == []
    assert source_differences(df.limit(0), "source", "v").collect() == []
    with pytest.raises(Exception, match="two rows"):
        source_differences(df.unionByName(df), "source", "v").collect()
    with pytest.raises(ValueError, match="more than 2"):
        source_differences(df, "source", "v", most=2)
