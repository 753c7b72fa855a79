"""Hints for keys that a join would lose."""

import random

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from tonnage.operators import normal_key, repair_hints


def test_planted_near_misses(frame):
    left = frame(
        [("Côte d’Ivoire ",), ("Côte d’Ivoire ",), ("KOREA, REP.",), ("Chad",), ("Nigar",), ("Atlantis",), (None,), ("--",)],
        "country string",
    )
    right = frame(
        [("Cote d'Ivoire", 1), ("Korea Rep", 2), ("Chad", 3), ("Chat", 3), ("Niger", 4), ("Niger", 5), ("Nigra", 6), (None, 7), ("", 8)],
        "name string, country int",
    )
    got = repair_hints(left, right, {"country": "name"})
    assert got.columns == ["key", "n_rows", "hint", "edits", "n_hints"]
    assert sorted(rows(got)) == sorted([
        ("Atlantis", 1, None, None, 0),
        ("Côte d’Ivoire ", 2, "Cote d'Ivoire", 0, 1),
        ("KOREA, REP.", 1, "Korea Rep", 0, 1),
        ("Nigar", 1, "Niger", 1, 1),
        ("--", 1, None, None, 0),
    ])
    two = {r.key: (r.hint, r.edits, r.n_hints) for r in repair_hints(left, right.where("name != 'Niger'"), {"country": "name"}, 2).collect()}
    assert two["Nigar"] == ("Nigra", 2, 1)
    assert repair_hints(left.limit(0), right, {"country": "name"}).collect() == []
    assert {r.n_hints for r in repair_hints(left, right.limit(0), {"country": "name"}).collect()} == {0}
    with pytest.raises(ValueError, match="one key"):
        repair_hints(left, right, ["country", "name"])
    with pytest.raises(ValueError, match="edits"):
        repair_hints(left, right, {"country": "name"}, 3)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("edits", [0, 1, 2])
def test_against_all_pairs(frame, edits):
    rng = random.Random(edits)
    words = ["".join(rng.choices("abc", k=rng.randrange(1, 7))) for _ in range(160)]
    left, right = words[:80], words[80:]
    want = []
    for key in set(left) - set(right):
        near = sorted((distance(key, w), w) for w in set(right))
        near = [x for x in near if x[0] <= edits]
        best = [x for x in near if x[0] == near[0][0]]
        want.append((key, left.count(key), best[0][1] if best else None, best[0][0] if best else None, len(best)))
    got = repair_hints(frame([(w,) for w in left], "k string"), frame([(w,) for w in right], "k string"), ["k"], edits)
    assert sorted(rows(got)) == sorted(want)


def test_normal_form_and_plan(frame):
    df = frame([(" São  Tomé & Príncipe",), ("Åland",), ("éa",), ("Ω7",), (None,)], "k string")
    assert [r[0] for r in df.select(normal_key(F.col("k"))).collect()] == ["sao tome principe", "aland", "ea", "ω7", None]
    text = plan(repair_hints(df, df.withColumn("other", F.lit(1)), ["k"]))
    assert "Cartesian" not in text and "NestedLoop" not in text and "Python" not in text
