from __future__ import annotations

import hashlib
import math
from collections import defaultdict

from samples import corpus, prose

from tonnage.llm import mixing
from tonnage.llm.mixing import mix, mixture, targets


def fill(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Targets by resharing the excess until none is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    goal = {s: 0.0 for s in names}
    left, open_ = share * sum(sizes.values()), set(names)
    while open_ and left > 1e-9:
        total = sum(weight[s] for s in open_)
        given = {s: left * weight[s] / total for s in open_}
        left = 0.0
        for s, amount in given.items():
            goal[s] += amount
            if goal[s] >= most * sizes[s]:
                left += goal[s] - most * sizes[s]
                goal[s] = float(most * sizes[s])
                open_.discard(s)
    return goal


def test_targets(spark):
    for sizes in ({"a": 100, "b": 10, "c": 1000, "d": 5, "é": 70, None: 40}, {"z": 7}, {"a": 0, "b": 0}, {None: 3, "B": 900, "a": 900}):
        totals = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in targets(totals).collect()}
        want = fill(sizes)
        assert all(abs(got[s] - want[s]) < 1e-5 for s in sizes), (got, want)


def check(rows, found):
    size, taken, target = defaultdict(int), defaultdict(int), {}
    for r in found:
        size[r.source] += r.size
        taken[r.source] += r.size * r.copies
        target[r.source] = r.target
        assert 0 <= r.copies <= 2
    want = fill(size)
    largest = max(r.size for r in found)
    for s in size:
        assert abs(target[s] - want[s]) < 1e-5
        assert abs(taken[s] - target[s]) <= 2 * largest
    assert sorted(((r.doc_id, r.size) for r in found), key=str) == sorted(((i, len((t or "").encode().split())) for i, t, _ in rows), key=str)


def test_mixture(documents):
    rows = [(i, prose(i, 1 + i * 7 % 40), "abc"[i * i % 3] if i % 11 else None) for i in range(400)] + [(5, "x", "a")] * 30
    docs = documents(rows)
    found = mixture(docs).collect()
    check(rows, found)
    again = mixture(docs.repartition(7, "text")).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))


def test_odd_rows_and_no_rows(documents):
    check(corpus(), mixture(documents(corpus())).collect())
    assert mixture(documents([])).collect() == []
    assert [r.copies for r in mixture(documents([(1, None, None), (2, "", "a")])).collect()] == [0, 0]


def test_mix_repeats_rows(documents):
    rows = [(i, prose(i, 20 + i % 5), "ab"[i % 2]) for i in range(60)] + [(None, "one two", "a"), (None, "three", "a")]
    docs = documents(rows)
    copies = {(r.doc_id, r.key): r.copies for r in mixture(docs).collect()}
    mixed = mix(docs)
    assert mixed.columns == docs.columns
    got = defaultdict(int)
    for r in mixed.collect():
        got[(r.doc_id, r.text)] += 1
    assert sum(got.values()) == sum(copies.values()) and max(got.values()) <= 2


def test_equal_rows_share_their_copies(spark, documents):
    # Rates below a half took none of them, when each got the rounded mean.
    rows = [(7, "one two three", "c")] * 900 + [(i, prose(i, 3), "c") for i in range(100, 200)]
    rows += [(i, prose(i, 30), "ab"[i % 2]) for i in range(1000, 1040)]
    docs = documents(rows)
    for weights in ((5, 2, 1), (50, 50, 1)):
        found = mixture(docs, weights=weights).collect()
        want = sum(r.copies for r in found if r.doc_id == 7)
        got = mix(docs, weights=weights).collect()
        assert sum(r.doc_id == 7 for r in got) == want > 0
        assert len(got) == sum(r.copies for r in found)


def test_mix_with_clashing_names_and_columns_that_differ(spark):
    names = ["doc_id", "text", "source", "key", "copies", "part", "__key", "last", "a.b"]
    rows = [(7, "x y", "a", i % 5, i, 1, 2, 3, i) for i in range(40)] + [(i, "z", "a", 1, 1, 1, 1, 1, 1) for i in range(9)]
    docs = spark.createDataFrame(rows, names)
    mixed, found = mix(docs), mixture(docs).collect()
    assert mixed.columns == names
    got = [tuple(r) for r in mixed.collect()]
    assert len(got) == sum(r.copies for r in found) and set(got) <= set(rows)
    assert max(got.count(r) for r in rows) <= 2


def test_nearest_of_16_offsets(documents):
    # Of the 16 the one nearest to the target is used; the first alone may miss it by more.
    rows = [(i, prose(i, 1 + i * i % 97), [*"abcdefg", None][i % 8]) for i in range(800)]
    found, missed = mixture(documents(rows)).collect(), 0
    for source in [*"abcdefg", None]:
        line = sorted((r for r in found if r.source == source), key=lambda r: (r.size, r.doc_id, r.key))
        target, rate = line[0].target, line[0].target / line[0].source_size
        start = int(hashlib.md5(f"mix-1:{source or ''}".encode()).hexdigest()[:8], 16) / 4294967296
        tries = []
        for turn in range(16):
            moved = (start + turn / 16) % 1
            copies = [math.floor((i + 1) * rate + moved) - math.floor(i * rate + moved) for i in range(len(line))]
            tries.append((abs(sum(r.size * c for r, c in zip(line, copies, strict=True)) - target), turn, copies))
        assert [r.copies for r in line] == min(tries)[2]
        missed += tries[0][0] > min(tries)[0]
    assert missed


def test_few_repeated_rows_move_no_text(documents, conf, monkeypatch):
    conf(spark__sql__autoBroadcastJoinThreshold="20KB")
    rows = [(i, f"word{i} b", "ab"[i % 2]) for i in range(8000)]
    plans, stage = [], mixing.stage

    def spy(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stage(df)

    monkeypatch.setattr(mixing, "stage", spy)
    for extra in ([], [(7, "again and again", "a")] * 40):
        plans.clear()
        mixed = mix(documents(rows + extra))
        # The keys taken are too many to be broadcast, and the text is moved once for them.
        assert "SortMergeJoin" in mixed._jdf.queryExecution().executedPlan().toString()
        semi = [p for p in plans if "LeftSemi" in p]
        assert semi and not any("SortMergeJoin" in p for p in semi)
