from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from samples import corpus
from tokenizers import Tokenizer

from tonnage.llm.tokens import EliasFano, Encoder, Shard, read_documents, write_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
OTHER = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 100_000)), min_size=0, max_size=900))
def test_elias_fano_round_trip(steps):
    values = np.cumsum(np.array(steps, np.int64))
    code = EliasFano.of(values)
    assert code.values().tolist() == values.tolist()
    assert [code.select(i) for i in range(0, len(values), 7)] == values[::7].tolist()
    bits = 8 * (code.low.nbytes + code.high.nbytes)
    assert bits <= len(values) * (3 + np.log2(max(values[-1] / len(values), 1))) + 24 if len(values) else True


def test_shard_round_trip():
    rng = random.Random(1)
    ids = [np.array([rng.randrange(60_000) for _ in range(rng.randrange(30))], "<u2") for _ in range(700)]
    shard = Shard.from_bytes(Shard.of(ids, "<u2").to_bytes())
    assert all(shard.document(i).tolist() == x.tolist() for i, x in enumerate(ids))
    with pytest.raises(ValueError):
        Shard.from_bytes(b"nothing" * 9)


TEXT = st.text(st.sampled_from(" \n\t\r\x0b\x1c\x85\xa0ab'sTé.,!12²×ǅß中\U0001f600_<|>"), max_size=40)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(TEXT, st.just("x <|endoftext|> y"), st.just("it's  we'll don'T 'S")), max_size=6))
def test_pieces_give_the_tokenizers_ids(texts):
    for path in (PATH, OTHER):
        code = CODES.setdefault(path, Encoder(path))
        want = [code.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert [x.tolist() for x in code.encode(texts)] == want


CODES: dict[str, Encoder] = {}


def expected(rows):
    tokenizer, start, out = Tokenizer.from_file(PATH), 0, []
    for name, text, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((name, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_whole_tables(spark, documents):
    for rows in (corpus(), [], [(None, None, None)] * 3):
        path = write_tokens(documents(rows).repartition(3), PATH, 2)
        assert sorted(map(tuple, read_documents(spark, path).collect()), key=str) == sorted(expected(rows), key=str)
