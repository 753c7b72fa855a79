"""Least-squares lines of logs from sums that can be added up."""

import math

import numpy as np
import pytest
from helpers import as_dict, rows
from pyspark.sql import functions as F

from tonnage.operators import add_sums, fit_line, fit_loglog, loglog_project, loglog_sums

NAN, INF = float("nan"), float("inf")


@pytest.fixture
def noisy(spark):
    rng = np.random.default_rng(1)
    x = np.exp(rng.normal(3, 1, 900))
    y = np.exp(-1.3 - 0.41 * np.log(x) + rng.normal(0, 0.2, 900))
    table = [(("a", "b", None)[i % 3], float(x[i]), float(y[i]), i) for i in range(900)]
    return spark.createDataFrame(table, "k string, x double, y double, i int")


def test_against_numpy(noisy):
    found = {r.k: r for r in fit_loglog(noisy, ["k"], "x", "y").collect()}
    for k in ("a", "b", None):
        of = [r for r in noisy.collect() if r.k == k]
        lx, ly = np.log([r.x for r in of]), np.log([r.y for r in of])
        b, a = np.polyfit(lx, ly, 1)
        assert (found[k].a, found[k].b) == (pytest.approx(a), pytest.approx(b))
        assert found[k].r2 == pytest.approx(np.corrcoef(lx, ly)[0, 1] ** 2)
        assert (found[k].n, found[k].n_left_out) == (300, 0)


def test_sums_of_parts_are_those_of_the_whole(noisy):
    whole = loglog_sums(noisy, ["k"], "x", "y")
    by_part = loglog_sums(noisy.withColumn("part", F.col("i") % 11), ["k", "part"], "x", "y")
    assert rows(add_sums(by_part, ["k"])) == rows(whole.select(*add_sums(by_part, ["k"]).columns))


def test_no_dependence_on_the_order_of_rows(noisy):
    one = fit_loglog(noisy.coalesce(1).orderBy("x"), ["k"], "x", "y")
    other = fit_loglog(noisy.repartition(9, "i"), ["k"], "x", "y")
    assert rows(one) == rows(other)


def test_what_has_no_logarithm_is_counted(frame):
    table = [("k", x, 2.0) for x in (None, NAN, 0.0, -1.0, INF)] + [("k", 1.0, y) for y in (None, NAN, 0.0, -3.0, INF)]
    table += [("k", 1.0, 2.0), ("k", math.e, 2.0 * math.e), ("none", None, 1.0), ("one", 3.0, 4.0), ("same", 3.0, 4.0), ("same", 3.0, 5.0), ("flat", 1.0, 2.0), ("flat", 2.0, 2.0)]
    found = {r.k: r for r in fit_loglog(frame(table, "k string, x double, y double"), ["k"], "x", "y").collect()}
    assert (found["k"].n, found["k"].n_left_out) == (2, 10)
    assert (found["k"].a, found["k"].b, found["k"].r2) == (pytest.approx(math.log(2)), pytest.approx(1), pytest.approx(1))
    for k, n in (("none", 0), ("one", 1), ("same", 2)):
        assert (found[k].a, found[k].b, found[k].r2, found[k].n) == (None, None, None, n)
    assert (found["flat"].b, found["flat"].r2) == (pytest.approx(0), None)


def test_an_empty_table_has_no_group(frame):
    assert fit_loglog(frame([], "k string, x double, y double"), ["k"], "x", "y").collect() == []
    assert fit_line(add_sums(loglog_sums(frame([], "x double, y double"), [], "x", "y"), []), []).collect()[0].n == 0


def test_a_table_of_coefficients_is_joined(frame):
    df = frame([("X", 10.0), ("Z", 0.0), ("N", None), (None, 2.0), ("lost", 1.0)], "r string, x double")
    pairs = frame([("X", "s", -1.3, -0.41), ("X", "c", -1.9, 0.5), ("Z", "s", 1.0, 2.0), ("N", "s", 1.0, 2.0), (None, "s", 0.0, 1.0)], "r string, m string, a double, b double")
    got = as_dict(loglog_project(df, "x", pairs, "m", "y", on=["r"]), "y", "r", "m")
    assert got == {
        ("X", "s"): pytest.approx(math.exp(-1.3 - 0.41 * math.log(10))), ("X", "c"): pytest.approx(math.exp(-1.9 + 0.5 * math.log(10))),
        ("Z", "s"): 0.0, ("N", "s"): None, (None, "s"): pytest.approx(2.0),
    }
    with pytest.raises(ValueError, match="keys"):
        loglog_project(df, "x", pairs, "m", "y")
