from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from samples import corpus, prose

from tonnage.llm import minhash
from tonnage.llm.components import components
from tonnage.llm.minhash import REGISTERS, drop_near_duplicates, estimates, filled, near_duplicates, shingle_sets, sketches_of
from tonnage.llm.words import texts_of
from tonnage.sources import staging


def shingles(text):
    table = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    words = (text or "").translate(table).encode().split()
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def brute(rows):
    sets = [shingles(t) for _, t, _ in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if rows[i][0] is not None and rows[j][0] is not None and a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[top(i)] = top(j)
    least = {}
    for i, (name, *_) in enumerate(rows):
        if name is not None:
            least[top(i)] = min(least.get(top(i), name), name)
    return [(r[0], len(s), least.get(top(i)) if r[0] is not None else None) for i, (r, s) in enumerate(zip(rows, sets, strict=True))]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def run(docs):
    return [tuple(r)[:3] for r in near_duplicates(docs).collect()]


def test_against_brute_force(documents):
    rows = corpus()
    assert order(run(documents(rows))) == order(brute(rows))


def test_chains_small_sets_and_groups(documents):
    rng = random.Random(9)
    rows = []
    words = prose(20, 60).split()
    for i in range(60):
        words = words[:]
        words[rng.randrange(60)] = f"n{i}"
        rows.append((1000 - i, " ".join(words), "a"))
    for i in range(120):
        rows.append((2000 + i, " ".join(rng.choices(["p", "q"], k=rng.randrange(1, 9))), "b"))
    assert order(run(documents(rows))) == order(brute(rows))


def test_kept_rows(documents):
    found = near_duplicates(documents([(5, "a b c d e f", "x"), (2, "A b c d e f", "x"), (None, "a b c d e f", "x"), (9, None, "x"), (9, "", "x")]))
    assert sorted(map(tuple, found.select("doc_id", "component_id", "kept").collect()), key=str) == sorted(
        [(5, 2, False), (2, 2, True), (None, None, True), (9, 9, True), (9, 9, True)], key=str
    )
    assert near_duplicates(documents([])).collect() == []


def test_one_document_of_each_group_stays(documents):
    docs = documents(corpus())
    left = drop_near_duplicates(docs)
    assert left.columns == docs.columns
    kept = sorted(r.doc_id for r in left.collect() if r.doc_id is not None)
    assert kept == sorted({c for _, _, c in brute(corpus()) if c is not None})


def test_components(frame):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (130, 129), (200, 201), (201, 200)]
    found = dict(map(tuple, components(frame(edges, "a long, b long")).collect()))
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 131), 100), 200: 200, 201: 200}
    assert components(frame([], "a long, b long")).collect() == []


def test_estimates_are_near_the_truth():
    rng = np.random.default_rng(3)
    for share in (0.2, 0.5, 0.75, 0.9):
        for size in (40, 400, 20_000):
            pool = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
            own = int(size * (1 - share) / 2)
            a, b = pool[own:], pool[: len(pool) - own]
            true = (len(pool) - 2 * own) / len(pool)
            sketches = sketches_of([a, b])
            got, used = estimates(sketches[:1], sketches[1:], np.array([len(a)]), np.array([len(b)]))
            assert abs(got[0] - true) < 5 * np.sqrt(true * (1 - true) / used[0]) + 0.02


def test_filled_registers_agree_like_the_sets():
    rng = np.random.default_rng(8)
    agree = []
    for _ in range(300):
        pool = np.unique(rng.integers(0, 2**64, 8, dtype=np.uint64))
        full = filled(sketches_of([pool[:7], pool[1:]]))
        assert (full > 0).all()
        agree.append((full[0] == full[1]).mean())
    assert abs(np.mean(agree) - 0.75) < 0.03
    assert not filled(sketches_of([pool[:0]])).any() and REGISTERS == full.shape[1]


def test_shingles_of_short_texts():
    sets = shingle_sets(texts_of(pa.array(["", None, "a b", "A  B", "a b c d e", "a b c d e f"])), 5)
    assert [len(s) for s in sets] == [0, 0, 1, 1, 1, 2]
    assert sets[2] == sets[3]


def test_boilerplate_below_the_threshold(documents):
    """Very many documents that share most of their text, but not enough, and a few that do."""
    rng = random.Random(4)
    shared = prose(3, 100).split()
    rows = []
    for i in range(20_000):
        own = [f"w{i}_{j}" for j in range(18 + i % 3)]
        rows.append((i, " ".join(shared + own), "a"))
    for i in range(40):
        copy = rows[i * 37][1].split()
        copy[-1] = f"z{i}"
        rows.append((100_000 + i, " ".join(copy), "b"))
    rng.shuffle(rows)
    found = {r.doc_id: r.component_id for r in near_duplicates(documents(rows)).collect()}
    want = {i: i for i in range(20_000)} | {100_000 + i: i * 37 for i in range(40)}
    assert found == want


def test_boilerplate_around_the_threshold(documents):
    """Shared passages of several lengths, so that classes link through their smallest documents."""
    rng = random.Random(8)
    passages = [prose(n, 60 + 5 * n).split() for n in range(3)]
    rows = []
    for i in range(150):
        body = list(passages[i % 3])
        if i % 4 == 1:
            body[rng.randrange(len(body))] = f"c{i % 8}"
        rows.append((i, " ".join(body + [f"w{i}_{j}" for j in range(rng.randrange(4, 16))]), "a"))
    assert order(run(documents(rows))) == order(brute(rows))


def test_sketches_are_held_once(spark, documents, monkeypatch):
    """Once the nodes have the sketches, those of the rows are gone."""
    before, held, stage = set(staging._staged), [], minhash.stage

    def spy(df):
        out = stage(df)
        held.append([p for p in staging._staged if p not in before and "sketch" in spark.read.parquet(p).columns])
        return out

    monkeypatch.setattr(minhash, "stage", spy)
    found = near_duplicates(documents([(i, prose(i // 2, 30), "a") for i in range(40)]))
    assert found.where("kept").count() == 20
    assert len(held) > 5 and all(len(tables) == 1 for tables in held[2:])
