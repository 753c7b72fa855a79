"""Invented documents for the tests."""

from __future__ import annotations

import random

WORDS = ["alpha", "Beta", "gamma,", "delta", "the", "of", "é", "中文", "x\x1cy", "end."]


def prose(seed: int, count: int, vocabulary=2000) -> str:
    """Words of an invented text, the same for the same seed."""
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) if rng.random() < 0.3 else f"w{rng.randrange(vocabulary)}" for _ in range(count))


def corpus() -> list[tuple]:
    """Copies, near copies, shared passages, repeated rows, nulls, empty and long texts."""
    passage, base = prose(1, 70), prose(2, 300)
    words = base.split()
    near = [" ".join(words[:k] + ["changed"] + words[k + 1 :]) for k in (10, 150, 290)]
    rows = [(10 + k, t, "a") for k, t in enumerate([base, *near, base, prose(3, 80) + " " + passage, passage + "\n" + prose(4, 40)])]
    rows += [(3, prose(5, 60) + "\t" + passage, "b"), (50, "word " * 400, "b"), (51, "word " * 30, None)]
    rows += [(52, "a b " * 60, None), (53, "a b " * 15, None), (60, "", "a"), (61, None, "a"), (62, " \n\t ", "b")]
    rows += [(63, "one two", "c"), (64, "One  TWO", "c"), (65, "one two three four five", "c"), (70, prose(6, 30_000), "b")]
    rows += [(71, prose(6, 30_000), "b"), (80, prose(7, 50), "c"), (80, prose(7, 50), "c"), (None, passage, "a"), (None, None, None)]
    return rows
