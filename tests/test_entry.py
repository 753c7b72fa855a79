"""Every registered query against its SQL on the smallest tables, and its plan."""

import os
from pathlib import Path

import pytest
from helpers import plan
from oracle import connect, differences

import __spark_entry__ as driver
from tonnage.catalog import FUNCTIONS, SQL

FOLDER = os.environ.get("TEST_SF_DIR", driver.SMALL)
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")

# Nodes that would run Python per row or pair every row with every other.
UNWANTED = ("PythonUDF", "EvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.fixture(scope="module")
def sql():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(FUNCTIONS))
def test_query(spark, sql, name):
    result = driver.queries()[name](spark, FOLDER)
    assert differences(result, sql, driver.oracle_sql()[name]) == []
    text = plan(result)
    assert [n for n in UNWANTED if n in text] == []


def test_every_query_has_its_sql():
    assert set(FUNCTIONS) == set(SQL)
    assert set(FUNCTIONS) <= set(driver.queries()) and set(driver.oracle_sql()) <= set(driver.queries())


def test_flagship(spark):
    assert driver.entry(spark).columns == [
        "region", "supplysector", "subsector", "stub_technology", "year", "cost_input", "cost",
    ]


def test_fact_tables_are_read_once(spark, monkeypatch):
    from tonnage.sources import staging

    monkeypatch.setattr(staging, "_staged", [])
    scans = {}
    for name in ("filter_missing", "unmatched_keys", "rollup_sum"):
        text = driver.queries()[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
        scans[name] = text.count("Relation [")
    assert scans == {"filter_missing": 1, "unmatched_keys": 2, "rollup_sum": 2}
    assert len(staging._staged) == 1  # both parts of rollup_sum read what was staged from one scan
