from __future__ import annotations

import math

import numpy as np
import pytest

from tonnage.llm import topk, vectors
from tonnage.llm.topk import Block, _posting_list, top_k

SCHEMA = "vec_id long, embedding array<float>, label int, row string, size string, x string, score string"


@pytest.fixture
def table(spark):
    def make(rows):
        return spark.createDataFrame([(i, v, 0, "r", "s", "x", "t") for i, v in rows], SCHEMA)

    return make


def usable(rows):
    return [(i, [math.floor(1024 * float(np.float32(c))) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]


def brute(rows, k=10):
    out = []
    rows = usable(rows)
    for n, (q, x) in enumerate(rows):
        if q is None or q % 100:
            continue
        others = [(-sum(a * b for a, b in zip(x, y, strict=True)), i is None, i) for m, (i, y) in enumerate(rows) if m != n and len(y) == len(x)]
        best = sorted(others, key=lambda o: (o[0], o[1], o[2] or 0))[:k]
        out += [(q, rank, i, -s) for rank, (s, _, i) in enumerate(best, 1)]
    return sorted(out, key=str)


def rows_of(df):
    return sorted(map(tuple, df.select("query_id", "rank", "vec_id", "score").collect()), key=str)


def odd_rows():
    rng = np.random.default_rng(5)
    rows = [(i, (rng.integers(-3, 4, 6) / 4).tolist()) for i in range(0, 400)]
    rows += [(500 + i, [0.5, 0.5, 0.0, 0.0, 0.25, -1.0]) for i in range(30)]
    rows += [(100, rows[100][1]), (None, rows[3][1]), (None, None), (700, None), (800, [1.0, None, 0.0, 0.0, 0.0, 0.0])]
    rows += [(900, [float("nan")] * 6), (1000, [float("inf")] + [0.0] * 5), (1100, [0.0] * 6), (1200, []), (1300, [])]
    rows += [(1400, [1.0, -1.0]), (1401, [2.0, 0.5]), (1500, [-1.0, -1.0]), (-100, [1.0] * 6)]
    return rows


def test_against_brute_force(table, monkeypatch):
    rows = odd_rows()
    # Several blocks and batches.
    monkeypatch.setattr(topk, "BLOCK_ROWS", 100)
    monkeypatch.setattr(topk, "BATCH_QUERIES", 3)
    assert rows_of(top_k(table(rows).repartition(3))) == brute(rows)


def test_fewer_rows_than_asked(table):
    rows = [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (2, [3.0, -2.0])]
    assert rows_of(top_k(table(rows))) == brute(rows)
    assert rows_of(top_k(table([(0, [1.0])]))) == []


def test_empty_tables(table):
    assert top_k(table([])).collect() == []
    assert top_k(table([(0, None), (1, [None])])).collect() == []


def test_components_too_large_stop_the_job(table):
    with pytest.raises(Exception, match="CAST_OVERFLOW|overflow"):
        top_k(table([(0, [1e10]), (1, [1.0])])).collect()
    with pytest.raises(OverflowError):
        vectors.check_width(np.array([[1 << 31]]), np.array([[1 << 31]]))


def block_of(x):
    lists = [_posting_list(x[:, d]) for d in range(x.shape[1])]
    return Block(x, np.array([p[0] for p in lists]), np.array([p[1] for p in lists]), [p[2] for p in lists], [p[3] for p in lists])


@pytest.mark.parametrize("spread", [2, 50, 3000])
def test_possible_members_hold_the_best(spread):
    rng = np.random.default_rng(spread)
    for trial in range(20):
        x = rng.integers(-spread, spread + 1, (int(rng.integers(20, 700)), 8))
        x -= rng.integers(-2, 3) * spread
        block = block_of(x)
        q = rng.integers(-spread, spread + 1, 8) * (rng.random(8) < 0.8)
        own = np.array([3]) if trial % 2 else np.zeros(0, np.int64)
        score = x @ q
        order = [i for i in np.lexsort((np.arange(len(x)), -score)).tolist() if i not in own]
        assert set(order[:10]) <= set(block.possible(q, 10, own).tolist())
        assert not set(own.tolist()) & set(block.possible(q, 10, own).tolist())


def test_search_ends_on_proof():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(5000, 16))
    x = np.floor(1024 * x / np.linalg.norm(x, axis=1)[:, None]).astype(np.int64)
    block = block_of(x)
    assert max(len(block.possible(x[i], 10, np.array([i]))) for i in range(20)) <= 5000 // topk.FEW_SHARE
