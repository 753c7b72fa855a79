from __future__ import annotations

import zlib

import pytest
from samples import corpus, prose

from tonnage.llm.toxicity import Lexicon, fold, learn, score_toxicity


def test_folding():
    assert fold("Ｉｄｉｏｔ 1D10T! іdіot, $cum").split() == ["idiot", "idiot", "idiot", "scum"]
    assert fold("") == "  " and "é" in fold("É")


def test_longest_entries_and_exceptions():
    lexicon = Lexicon({" scum ": 4.0, " pond scum ": 0.0, " foul": 3.0, " foulard ": 0.0})
    assert lexicon.hits(fold("Scum, scum.")) == [(4.0, 0.0)] * 2
    assert lexicon.hits(fold("pond scum")) == []
    assert lexicon.hits(fold("fouls foulard")) == [(3.0, 0.0)]
    lexicon = Lexicon({" scum ": 4.0}, certain={" scum ": 0.98})
    assert lexicon.score("fine " * 5000 + "scum") == 0.98 and lexicon.score("fine") < 0.5
    assert Lexicon({}).hits(fold("scum")) == []


@pytest.fixture
def labelled(spark, documents):
    """Texts with an ugly word or an ugly beginning are toxic; ugly words of clean texts are exceptions."""
    rows, marks = [], []
    for i in range(500):
        toxic = i % 4 == 0
        bad = ["vile", "b4stardly", "ugling", "uglick"][i // 4 % 4] if toxic else ["uglare", "fine"][i % 2]
        rows.append((i, prose(i, 20 + i % 50) + f" {bad} " + prose(i + 999, 10), "a"))
        marks.append((i, 1, int(toxic)))
    marks += [(7000, 1, 1), (None, 1, 1), (3, 1, None)]
    return documents(rows), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(labelled):
    docs, labels = labelled
    rows = score_toxicity(docs, learn(docs, labels)).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    out = [r for r in rows if r.held_out]
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in out) >= 0.97 * len(out)


def test_all_entries_that_qualify_are_kept(spark, documents):
    # 900 bad words, 90 in each toxic document in turn.
    bad = [f"bad{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyzabcd'[i // 100]}x" for i in range(900)]
    rows = [(i, prose(i, 30) + " " + " ".join(bad[i * 10 % 900 :][:90] if i % 2 else []), "a") for i in range(600)]
    marks = spark.createDataFrame([(i, 1, i % 2) for i in range(600)], "doc_id long, quality int, toxic int")
    weights = learn(documents(rows), marks).weights
    assert all(any(f" {w} ".startswith(x) and v > 0 for x, v in weights.items()) for w in bad)


def test_held_out_labels_are_not_used(labelled):
    docs, labels = labelled
    turned = labels.selectExpr("doc_id", "quality", "if(crc32(cast(cast(doc_id as string) as binary)) % 3 = 1, 1 - toxic, toxic) as toxic")
    a, b = learn(docs, labels), learn(docs.repartition(3), turned)
    assert a.weights == b.weights and a.line == b.line


def test_labels_of_one_kind_or_none(labelled, documents):
    docs, labels = labelled
    for some, high in ((labels.where("toxic = 0"), False), (labels.where("toxic = 1"), True), (labels.where("false"), False)):
        scores = {r.score for r in score_toxicity(documents(corpus()), learn(docs, some)).collect()}
        assert len(scores) == 1 and (scores.pop() > 0.7) == high
    assert score_toxicity(documents([]), learn(docs, labels)).collect() == []
    odd = score_toxicity(documents([(None, None, None), (1, "", "a")]), learn(docs, labels)).collect()
    assert sorted((r.doc_id is None, r.held_out, r.predicted) for r in odd) == [(False, zlib.crc32(b"1") % 3 == 1, 0), (True, False, 0)]
