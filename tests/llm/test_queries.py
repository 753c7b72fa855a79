"""The registered queries against their SQL on the smallest tables, and their plans."""

from __future__ import annotations

import os
import re
from pathlib import Path

import pytest
from helpers import plan
from oracle import connect, differences

import __spark_entry__ as driver
from tonnage.llm.queries import QUERIES, SQL

FOLDER = os.environ.get("TEST_SF_DIR", driver.SMALL)
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")

COLUMNS = {
    "op1": "page_id host path rule verdict",
    "op2": "doc_id n_words n_removed kept_sha256",
    "op3": "doc_id start n_tokens ids_crc32",
    "op4": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op5": "doc_id n_shingles component_id kept",
    "op6": "doc_id held_out score predicted",
    "op7": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op8": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op9": "doc_id item_id",
    "op10": "doc_id size source_size target taken",
    "op11": "item_id rank doc_id score",
    "op12": "query_id rank vec_id score",
    "op13": "anchor_id positive_id rank negative_id positive_score negative_score",
}


@pytest.fixture(scope="module")
def sql():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(SQL))
def test_query_against_sql(spark, sql, name):
    assert differences(QUERIES[name](spark, FOLDER), sql, SQL[name]) == []


@pytest.mark.parametrize("name", list(QUERIES))
def test_columns_and_plan(spark, name):
    found = QUERIES[name](spark, FOLDER)
    assert set(COLUMNS[name.split("_")[0]].split()) <= set(found.columns)
    assert not re.search("CartesianProduct|BroadcastNestedLoop|BatchEvalPython", plan(found))


def test_the_driver_sees_them():
    assert set(QUERIES) | {"pipeline"} <= set(driver.queries())
    assert set(SQL) <= set(driver.oracle_sql())
