from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from samples import corpus, prose

from tonnage.llm import lexical
from tonnage.llm.lexical import List, best_documents, index_documents, ranked_search, search
from tonnage.sources.staging import stage


def terms(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(lexical.TERM_PATTERN, lowered)


def brute(docs, items, k=10):
    """All rows item_id, rank, doc_id, score, worked out as the contract states it."""
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n, total = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    asked = defaultdict(set)
    for i, t in items:
        if i is not None:
            asked[i] |= set(terms(t))
    rows = []
    for item, wanted in asked.items():
        scores = []
        for doc, c in counts:
            m = 100 - 90 + (90 * c.total() * n) // total
            gains = [math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in wanted if t in c]
            if sum(gains) > 0:
                scores.append((-sum(gains), doc is None, doc))
        rows += [(item, rank, doc, -s) for rank, (s, _, doc) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(rows, key=str)


def rows_of(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


ITEMS = [(1, "alpha BETA gamma w7 w11 w13"), (2, "é 中文 w1"), (2, "w2 alpha"), (3, None), (4, ""), (5, "not-there"), (None, "alpha"), (6, "one two three"), (7, prose(6, 300)), (7, prose(6, 300))]


@pytest.fixture
def items(spark):
    rows = [(i, t, "doc", 1, 2) for i, t in ITEMS]
    return spark.createDataFrame(rows, "item_id long, text string, term string, rank int, score int")


def test_against_brute_force(documents, items, monkeypatch):
    docs = [(i, t) for i, t, _ in corpus()]
    assert rows_of(ranked_search(documents(corpus()).repartition(3), items)) == brute(docs, ITEMS)


def test_blocks_of_items_and_more_documents_asked(documents, items, monkeypatch):
    monkeypatch.setattr(lexical, "ITEMS", 2)
    index = stage(index_documents(documents(corpus()).coalesce(1)))
    assert rows_of(search(index, items, 3)) == brute([(i, t) for i, t, _ in corpus()], ITEMS, 3)


def test_empty_tables(spark, documents, items):
    nothing = items.where("false")
    assert ranked_search(documents([]), items).collect() == []
    assert ranked_search(documents([(1, None, "a"), (2, " ,;", "a")]), items).collect() == []
    assert ranked_search(documents(corpus()[:3]), nothing).collect() == []


def test_lists_do_not_depend_on_segments(spark, documents):
    docs = documents(corpus()).coalesce(1)
    rows = index_documents(docs).groupBy("term").sum("df", "total").collect()
    assert {r.term for r in rows} == {t for _, x, _ in corpus() for t in terms(x)} | {""}
    want = Counter(t for _, x, _ in corpus() for t in terms(x))
    assert {r.term: r["sum(total)"] for r in rows if r.term} == want


def test_one_long_text(documents, spark):
    text = prose(11, 400_000, 50_000)
    items = spark.createDataFrame([(1, "w17 w18 alpha")], "item_id long, text string")
    docs = [(1, text), (2, "w17"), (3, None), (4, "none of them")]
    assert rows_of(ranked_search(documents([(i, t, "a") for i, t in docs]), items)) == brute(docs, [(1, "w17 w18 alpha")])


@pytest.mark.parametrize("stride", [1, 7, 1000])
def test_skipping_is_exact(monkeypatch, stride):
    monkeypatch.setattr(lexical, "STRIDE", stride)
    rng = np.random.default_rng(stride)
    for trial in range(60):
        documents = int(rng.integers(1, 400))
        lists, sums = [], np.zeros(documents, np.int64)
        for share in rng.choice([0.005, 0.02, 0.3, 0.9], int(rng.integers(0, 9))):
            docs = np.flatnonzero(rng.random(documents) < share)
            # Few distinct gains, so that there are many ties.
            gain = rng.integers(0, 4, len(docs)) * int(rng.integers(1, 5))
            lists.append(List(docs, gain, int(gain.max(initial=0))))
            sums[docs] += gain
        docs, score = best_documents(lists, documents, 5)
        want = sorted((-s, d) for d, s in enumerate(sums.tolist()) if s > 0)[:5]
        got = [(-s, d) for d, s in zip(docs.tolist(), score.tolist(), strict=True) if s > 0]
        assert got == want, trial


def test_long_lists_are_skipped():
    rng = random.Random(1)
    documents = 1 << 15
    rare = np.sort(np.array(rng.sample(range(2000), 50)))
    common = np.arange(documents)
    lists = [List(rare, np.full(50, 1000), 1000), List(common, common % 7, 6)]
    docs, score = best_documents(lists, documents, 10)
    want = sorted((-(1000 + d % 7), d) for d in rare.tolist())[:10]
    assert list(zip((-score).tolist(), docs.tolist(), strict=True)) == want
