from __future__ import annotations

import random
import re

from samples import corpus

from tonnage.llm.substring import remove_repeats


def brute(rows, size):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t, _ in rows]
    first = {}
    for (i, *_), w in zip(rows, words, strict=True):
        if i is not None:
            for k in range(len(w) - size + 1):
                content = tuple(w[k : k + size])
                first[content] = min(first.get(content, i), i)
    out = []
    for (i, *_), w in zip(rows, words, strict=True):
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if i is not None and first[tuple(w[k : k + size])] < i:
                gone[k : k + size] = [True] * size
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def run(docs, size):
    return [tuple(r) for r in remove_repeats(docs, size).select("doc_id", "n_words", "n_removed", "kept").collect()]


def test_against_brute_force(documents):
    rows = corpus()
    got = run(documents(rows), 13)
    assert order(got) == order(brute(rows, 13))
    assert sum(r[2] for r in got) > 30_000


def test_small_alphabets(documents):
    rng = random.Random(4)
    rows = [(i // 2 if i < 6 else i, " ".join(rng.choices("ab", k=rng.randrange(60))), "s") for i in range(40)]
    for size in (3, 13):
        assert order(run(documents(rows), size)) == order(brute(rows, size))


def test_spans_are_what_went(documents):
    rows = corpus()
    for r in remove_repeats(documents(rows)).collect():
        assert sum(s.end - s.start for s in r.spans) == r.n_removed


def test_no_documents(documents):
    assert run(documents([]), 13) == []
    assert run(documents([(1, None, "a"), (2, "", "a")]), 13) == [(1, 0, 0, ""), (2, 0, 0, "")]
