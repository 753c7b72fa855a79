from __future__ import annotations

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from samples import corpus, prose
from test_minhash import brute as brute_groups
from test_quality import brute as brute_counts

import public_tokenizers
from tonnage.llm.mixing import mixture
from tonnage.llm.quality import judge_quality, train
from tonnage.llm.queries import QUERIES


@pytest.fixture
def folder(spark, documents, tmp_path):
    rows = corpus() + [(1000 + i, prose(3000 + i, 60), "abc"[i % 3]) for i in range(90)]
    rows += [(2000 + i, " ".join(w + "&&&" for w in prose(4000 + i, 60).split()), "a") for i in range(60)]
    rows += [(3000, prose(77, 55) + " " + prose(500, 40), "b")]
    marks = [(1000 + i, 1, 0) for i in range(90)] + [(2000 + i, 0, 0) for i in range(60)]
    documents(rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, prose(500, 40))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path), rows


def test_stages_one_by_one(spark, folder, tmp_path):
    folder, rows = folder
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    steps = [docs]
    for number, (_, work) in enumerate(corpus_pipeline.STAGES):
        work(spark, steps[-1], folder).write.parquet(str(tmp_path / f"out{number}"))
        steps.append(spark.read.parquet(str(tmp_path / f"out{number}")))
    assert all(step.columns == docs.columns for step in steps[:-1])
    start, good, single, clean, mixed, tokens = [[tuple(r) for r in step.collect()] for step in steps]

    kept = {r.doc_id for r in judge_quality(docs, train(docs, spark.read.parquet(f"{folder}/labels.parquet"))).where("kept").collect()}
    assert {r[0] for r in good} == kept and not any(brute_counts(r[1])[-1] for r in good)
    assert not any(r[0] is not None and 2000 <= r[0] < 3000 for r in good) and len([r for r in good if r[0] and 1000 <= r[0] < 2000]) == 90

    triples = [(r[0], r[1], r[3]) for r in good]
    groups = {c for _, _, c in brute_groups(triples) if c is not None}
    assert sorted(r[0] for r in single if r[0] is not None) == sorted(groups)

    assert {r[0] for r in single} - {r[0] for r in clean} == {3000}
    assert sorted(map(str, clean)) == sorted(str(r) for r in single if r[0] != 3000)

    assert set(map(str, mixed)) <= set(map(str, clean)) and max(np.unique(list(map(str, mixed)), return_counts=True)[1]) <= 2
    found = mixture(steps[3]).collect()
    assert len(mixed) == sum(r.copies for r in found)
    assert sum(len(r[1].encode().split()) for r in mixed) == sum(r.size * r.copies for r in found)

    tokenizer, at, want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0, []
    for r in sorted(mixed, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        ids = tokenizer.encode(r[1], add_special_tokens=False).ids + [2]
        want.append((r[0], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(str, tokens)) == sorted(map(str, want))
    assert sorted(map(str, map(tuple, corpus_pipeline.run(spark, folder).collect()))) == sorted(map(str, want))


def test_empty_documents(spark, folder, documents):
    folder, _ = folder
    docs = documents([])
    for _, work in corpus_pipeline.STAGES:
        assert work(spark, docs, folder).collect() == []


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
