"""Joins: missing keys, merged keys, suffixes, cardinality, and skewed keys."""

import pytest
from helpers import plan, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tonnage.operators import (
    join_checked,
    join_full,
    join_inner,
    join_left,
    keep,
    rows_without_match,
    unmatched_keys,
)


@pytest.fixture
def left(frame):
    return frame([(1, 1.0), (None, 2.0), (3, 3.0)], "k int, v double")


@pytest.fixture
def right(frame):
    return frame([(1, 10.0), (None, 20.0), (4, 40.0)], "k int, w double")


def test_missing_keys_match(left, right):
    assert rows(join_left(left, right)) == [(None, 2.0, 20.0), (1, 1.0, 10.0), (3, 3.0, None)]
    assert rows(join_inner(left, right)) == [(None, 2.0, 20.0), (1, 1.0, 10.0)]


def test_full_join_merges_keys(left, right):
    assert rows(join_full(left, right, ["k"])) == [
        (None, 2.0, 20.0), (1, 1.0, 10.0), (3, 3.0, None), (4, None, 40.0),
    ]


def test_differently_named_keys_keep_the_left_name(left, frame):
    other = frame([(1, "a")], "id int, s string")
    assert join_left(left, other, {"k": "id"}).columns == ["k", "v", "s"]
    assert join_full(left, other, {"k": "id"}).columns == ["k", "v", "s"]


def test_suffixes(left):
    joined = join_left(left, left, ["k"], suffixes=(".t", ".g"))
    assert joined.columns == ["k", "v.t", "v.g"]
    assert rows(joined) == [(None, 2.0, 2.0), (1, 1.0, 1.0), (3, 3.0, 3.0)]
    assert join_full(left, left, ["k"], (".t", ".g")).columns == ["k", "v.t", "v.g"]


def test_no_shared_name_is_an_error(left, frame):
    with pytest.raises(ValueError, match="no shared column"):
        join_left(left, frame([(1,)], "other int"))


def test_keys_of_different_kinds_are_an_error(left, frame):
    with pytest.raises(TypeError, match="cannot join"):
        join_left(left, frame([("1", 2.0)], "k string, w double"), ["k"])
    assert join_left(left, frame([(1, 2.0)], "k bigint, w double"), ["k"]).count() == 3


def test_cardinality(left, right, frame):
    doubled = right.unionByName(right)
    assert join_left(left, doubled, ["k"]).count() == 5
    for expect in ("m:1", "1:1"):
        with pytest.raises(Exception, match="more than once"):
            join_left(left, doubled, ["k"], expect=expect).collect()
    twice = left.unionByName(left)
    assert len(join_left(twice, right, ["k"], expect="m:1").collect()) == 6
    with pytest.raises(Exception, match="more than once"):
        join_left(twice, right, ["k"], expect="1:1").collect()
    unused = right.unionByName(frame([(9, 1.0), (9, 2.0)], "k int, w double"))
    assert join_left(left, unused, ["k"], expect="1:1").count() == 3
    keys_only = keep(doubled, "k")
    with pytest.raises(Exception, match="more than once"):
        join_left(left, keys_only, ["k"], expect="m:1").collect()
    assert join_left(left, keep(right, "k"), ["k"], expect="m:1").count() == 3
    with pytest.raises(ValueError, match="expect is"):
        join_left(left, right, ["k"], expect="1:m")


def test_checked_join(left, right, frame):
    complete = frame([(1, 10.0), (None, 20.0), (3, 30.0)], "k int, w double")
    assert rows(join_checked(left, complete, ["k"])) == [
        (None, 2.0, 20.0), (1, 1.0, 10.0), (3, 3.0, 30.0),
    ]
    with pytest.raises(Exception, match="no match, or no value"):
        join_checked(left, right, ["k"]).collect()
    with pytest.raises(Exception, match="more than once"):
        join_checked(left, complete.unionByName(complete), ["k"]).collect()
    unused = complete.unionByName(frame([(9, 1.0), (9, 2.0)], "k int, w double"))
    assert join_checked(left, unused, ["k"]).count() == 3
    with pytest.raises(Exception, match="no match, or no value"):
        join_checked(left, right, ["k"], guarded=["v"]).select("v").collect()
    gaps = frame([(1, 10.0), (None, None), (3, float("nan"))], "k int, w double")
    with pytest.raises(Exception, match="no match, or no value"):
        join_checked(left, gaps, ["k"]).collect()
    assert join_checked(left, gaps, ["k"], may_be_missing=["w"]).count() == 3


def test_missing_keys_need_not_match(left, right):
    assert rows(join_inner(left, right, nulls="never")) == [(1, 1.0, 10.0)]
    assert rows(join_left(left, right, nulls="never")) == [(None, 2.0, None), (1, 1.0, 10.0), (3, 3.0, None)]
    with pytest.raises(ValueError, match="match or never"):
        join_left(left, right, nulls="maybe")


def test_full_join_of_single_rows(left, right):
    one = join_full(left, right, ["k"], one_row_per_key=True)
    assert rows(one) == rows(join_full(left, right, ["k"])) and one.columns == ["k", "v", "w"]


def scans(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_scans_and_exchanges(spark, conf, tmp_path):
    """Each side is read once where it can be, and a checked join sorts no full rows to aggregate them."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.range(50).selectExpr("id as k", "id * 2 as v").write.parquet(a)
    spark.range(30, 90).selectExpr("id as k", "cast(id as string) as w").write.parquet(b)
    left, right = spark.read.parquet(a), spark.read.parquet(b)
    assert scans(unmatched_keys(left, right, ["k"])) == 2
    assert scans(join_full(left, right, ["k"], one_row_per_key=True)) == 2
    assert plan(join_full(left, right, ["k"], one_row_per_key=True)).count("Exchange hash") == 2
    checked = plan(join_checked(left, right, ["k"]))
    assert "SortAggregate" not in checked
    grouped = left.groupBy("k").agg(F.sum("v").alias("v"))
    assert plan(join_inner(grouped, right, ["k"], nulls="never")).count("Exchange hash") == 2
    assert plan(join_inner(grouped, right, ["k"])).count("Exchange hash") == 3


def test_keys_proved_unique_are_not_counted(spark, tmp_path, frame):
    """Sides that were grouped by the keys are read once each, and the four errors still raise."""
    from tonnage.operators.joins import proved_unique

    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.range(50).selectExpr("id as k", "id % 5 as m", "id * 2 as v").write.parquet(a)
    spark.range(90).selectExpr("id % 60 as k", "id % 5 as n", "id as w").write.parquet(b)
    left, right = spark.read.parquet(a), spark.read.parquet(b)
    sums = right.groupBy("k").agg(F.sum("w").alias("w"))
    assert proved_unique(sums, ["k"]) and proved_unique(sums, ["k", "w"]) and not proved_unique(sums, ["w"])
    assert proved_unique(sums.where("w > 3").withColumnRenamed("k", "key").select("w", "key"), ["key"])
    assert not proved_unique(right, ["k"]) and not proved_unique(right.groupBy("k", "n").count(), ["k"])
    assert not proved_unique(sums.unionByName(sums), ["k"])
    assert proved_unique(right.select("k", "n").distinct(), ["n", "k"])
    assert scans(join_checked(left, sums, ["k"])) == 2
    assert scans(join_left(left, sums, ["k"], expect="m:1")) == 2
    assert scans(join_left(left.groupBy("k").agg(F.sum("v").alias("v")), sums, ["k"], expect="1:1")) == 2
    assert join_checked(left, sums, ["k"]).count() == 50
    some = sums.where("k < 40")
    with pytest.raises(Exception, match="no match, or no value"):
        join_checked(left, some, ["k"]).collect()
    with pytest.raises(Exception, match="no match, or no value"):
        join_checked(left, sums.withColumn("w", F.nullif(F.col("w"), F.lit(31))), ["k"]).collect()
    with pytest.raises(Exception, match="more than once"):
        join_checked(left, right, ["k"]).collect()
    with pytest.raises(Exception, match="more than once"):
        join_left(left, sums, {"m": "k"}, expect="1:1").collect()


def test_unmatched_keys(left, right):
    twice = left.unionByName(left)
    assert rows(unmatched_keys(twice, right, ["k"])) == [(3, 2, "left"), (4, 1, "right")]
    assert rows(rows_without_match(left, right, ["k"])) == [(3, 3.0)]


KEYS = st.lists(st.one_of(st.none(), st.integers(0, 3)), max_size=6)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(KEYS, KEYS)
def test_full_join_against_brute_force(spark, lk, rk):
    a = spark.createDataFrame([(k, i) for i, k in enumerate(lk)], "k int, a int")
    b = spark.createDataFrame([(k, i) for i, k in enumerate(rk)], "k int, b int")
    want = [(x, i, j) for i, x in enumerate(lk) for j, y in enumerate(rk) if x == y]
    want += [(x, i, None) for i, x in enumerate(lk) if x not in rk]
    want += [(y, None, j) for j, y in enumerate(rk) if y not in lk]
    key = lambda r: [(v is not None, str(v)) for v in r]
    assert rows(join_full(a, b, ["k"])) == sorted(want, key=key)


def test_a_hot_key_is_split(spark, conf, frame):
    """A third of the rows on one key: adaptive execution splits that partition."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="32KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="32KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__shuffle__partitions="16",
    )
    hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).cast("int")
    big = spark.range(0, 120_000, 1, 12).select(hot.alias("k"), F.rand(1).alias("v"))
    key = F.when(F.col("id") >= 0, F.col("id")).cast("int")  # nullable, as from a file
    dim = spark.range(5000).select(key.alias("k"), F.rand(2).alias("w"))
    for joined in (
        join_left(big, dim, ["k"]),
        join_left(big, dim, ["k"], expect="m:1"),
        join_checked(big, dim, ["k"]),
        join_full(big, dim, ["k"]),
    ):
        totals = joined.agg(F.count(F.lit(1)), F.sum("v"), F.sum("w"))
        assert totals.collect()[0][0] == 120_000
        assert "skew=true" in plan(totals)  # only a final plan says so


def test_a_small_side_is_broadcast_without_a_hint(spark, tmp_path):
    path = str(tmp_path / "dim")
    spark.range(100).withColumn("w", F.lit(1.0)).write.parquet(path)
    dim = keep(spark.read.parquet(path), "id", "w")
    big = spark.range(1000).withColumn("v", F.lit(1.0))
    assert "BroadcastHashJoin" in plan(join_left(big, dim, ["id"]))
