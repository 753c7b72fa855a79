from __future__ import annotations

import pytest

from tonnage.llm.ship import workers_find_library

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, size string, kept string, node int"


@pytest.fixture(autouse=True)
def _workers(spark):
    workers_find_library(spark)


@pytest.fixture
def documents(spark):
    """A documents table with extra columns whose names the operators use themselves."""

    def make(rows):
        full = [(i, t, "en", s, None if t is None else len(t), "k", "s", "x", 1) for i, t, s in rows]
        return spark.createDataFrame(full, DOCS)

    return make
