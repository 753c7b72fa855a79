"""Table verbs: what they return and what they refuse."""

import pytest
from helpers import as_dict, rows
from pyspark.sql import functions as F

from tonnage.operators import (
    across,
    bind_rows,
    discard,
    distinct_rows,
    drop_incomplete,
    find_names,
    keep,
    longer,
    mutate,
    quoted,
    rename,
    split_missing,
    to_numbers,
    wider,
    wider_found,
    year_table,
)

NAN = float("nan")


def test_unknown_columns_are_errors(frame):
    df = frame([(1, 2)], "a int, b int")
    for call in (
        lambda: keep(df, "x"),
        lambda: discard(df, "x"),
        lambda: rename(df, {"x": "y"}),
        lambda: longer(df, ["x"], "n"),
        lambda: drop_incomplete(df, ["x"]),
        lambda: distinct_rows(df, ["x"]),
    ):
        with pytest.raises(ValueError, match="no column"):
            call()
    with pytest.raises(ValueError, match="two columns of one name"):
        rename(df, {"a": "b"})


def test_rename_may_swap(frame):
    df = rename(frame([(1, 2)], "a int, b int"), {"a": "b", "b": "a"})
    assert df.first().asDict() == {"b": 1, "a": 2}


def test_names_with_dots_and_spaces(frame):
    df = frame([(1, 2.0, 3.0)], "`id no` int, `v.2015` double, `v.2050` double")
    long = longer(df, ["v.2015", "v.2050"], "name")
    assert rows(long) == [(1, "v.2015", 2.0), (1, "v.2050", 3.0)]
    assert keep(df, "v.2050").first()[0] == 3.0
    assert wider(long, "name", "value", ["v.2015", "v.2050"]).columns == df.columns
    assert drop_incomplete(df, ["v.2015"]).count() == 1


def test_mutate_sees_earlier_and_overwritten_columns(frame):
    df = mutate(frame([(2.0,)], "x double"), x=F.col("x") * 10, y=F.col("x") + 1)
    assert tuple(df.first()) == (20.0, 21.0)


def test_drop_incomplete_drops_null_and_nan(frame):
    df = frame([(1.0, "a"), (None, "a"), (NAN, "a"), (1.0, None)], "x double, s string")
    assert rows(drop_incomplete(df)) == [(1.0, "a")]
    assert drop_incomplete(df, ["x"]).count() == 2


def test_split_missing(frame):
    df = frame([(1, "a"), (2, None)], "k int, s string")
    present, missing = split_missing(df, "s")
    assert rows(present) == [(1, "a")]
    assert rows(missing) == [(2, None)]
    present, missing = split_missing(frame([(1.0,), (NAN,), (None,)], "x double"), "x")
    assert present.count() == 1
    assert missing.count() == 2


def test_bind_rows(frame):
    a = frame([(1, "x")], "k int, s string")
    b = frame([("y", 2.0)], "s string, v double")
    assert rows(bind_rows(a, b)) == [(None, "y", 2.0), (1, "x", None)]
    with pytest.raises(TypeError, match="different types"):
        bind_rows(a, frame([("1",)], "k string"))


def test_longer_keeps_null(frame):
    df = frame([("a", 1.0, None)], "k string, p double, q double")
    assert rows(longer(df, ["p", "q"], "n")) == [("a", "p", 1.0), ("a", "q", None)]


def test_wider_and_back(frame):
    df = frame([("a", "p", 1.0), ("a", "q", 2.0), ("b", "p", 3.0)], "k string, n string, v double")
    wide = wider(df, "n", "v", ["p", "q", "r"])
    assert rows(wide) == [("a", 1.0, 2.0, None), ("b", 3.0, None, None)]
    back = longer(wide, ["p", "q", "r"], "n", "v").where(F.col("v").isNotNull())
    assert rows(keep(back, "k", "n", "v")) == rows(df)


def test_wider_refuses_two_rows_for_a_cell(frame):
    df = frame([("a", "p", 1.0), ("a", "p", 2.0)], "k string, n string, v double")
    with pytest.raises(Exception, match="two rows for one cell"):
        wider(df, "n", "v", ["p"]).collect()


def test_across_needs_no_join(frame):
    df = across(frame([("a",), ("b",)], "k string"), "year", [2015, 2020])
    assert rows(df) == [("a", 2015), ("a", 2020), ("b", 2015), ("b", 2020)]
    with pytest.raises(ValueError, match="exists already"):
        across(df, "year", [1])


def test_year_table(spark):
    assert [r.year for r in year_table(spark, range(2020, 2101, 5)).collect()] == list(
        range(2020, 2101, 5)
    )


def test_to_numbers_and_quoted(frame):
    df = to_numbers(frame([("1000", "1,000")], "`a b` string, c string"), "a b", "c")
    assert tuple(df.first()) == (1000.0, None)
    assert df.select(quoted("a b")).first()[0] == 1000.0


def test_distinct(frame):
    df = frame([(1, 0.5), (1, 0.5), (2, 0.5)], "a int, b double")
    assert distinct_rows(df).count() == 2
    assert as_dict(distinct_rows(df, ["b"]), "b", "b") == {0.5: 0.5}


def test_names_found_in_the_data(spark, frame):
    df = frame([(1, "b", 2.0), (1, "a", 3.0), (2, "b", None)], "k int, n string, v double")
    assert find_names(df, "n", 2) == ["a", "b"]
    wide = wider_found(df, "n", "v")
    assert wide.columns == ["k", "a", "b"] and rows(wide) == [(1, 3.0, 2.0), (2, None, None)]
    with pytest.raises(ValueError, match="more than 1"):
        wider_found(df, "n", "v", most=1)
    with pytest.raises(ValueError, match="missing"):
        find_names(df.unionByName(frame([(3, None, 1.0)], "k int, n string, v double")), "n", 9)
