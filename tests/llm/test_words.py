from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tonnage.llm import recompress as R
from tonnage.llm.words import LOWER, blocks, sequence_hashes, texts_of, whole_windows, window_hashes, words_of

TEXT = st.text(st.sampled_from("ab \t\n\x0b\x1cÉé中Z"), max_size=60)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=8))
def test_words_and_their_hashes(texts):
    batch = pa.record_batch({"text": pa.array(texts, pa.string())})
    found, names = [], {}
    for _, block in blocks([batch], "text", 40):
        words = words_of(block)
        for i in range(len(block)):
            mine = range(words.first[i], words.first[i + 1])
            found.append([block.data[words.start[k] : words.end[k]].tobytes().decode() for k in mine])
            for k, word in zip(mine, found[-1], strict=True):
                assert names.setdefault(word, words.hash[k]) == words.hash[k]
    assert found == [split(t) for t in texts]
    assert len(set(names.values())) == len(names)


def test_lower_case_is_ascii_only():
    words = words_of(texts_of(pa.array(["ABZ abz É é"])), fold=LOWER)
    assert words.hash[0] == words.hash[1] and words.hash[2] != words.hash[3]


def test_a_word_longer_than_a_slab():
    texts = texts_of(pa.array(["x" * 3_000_000 + " y", "x" * 3_000_000, "y"]))
    words = words_of(texts)
    assert words.hash[0] == words.hash[2] and words.hash[1] == words.hash[3]


def test_windows_stay_inside_texts():
    first = np.array([0, 3, 3, 4, 9])
    assert whole_windows(first, 3).tolist() == [0, 4, 5, 6]
    hashes = np.arange(9, dtype=np.uint64) % 3
    assert window_hashes(hashes, 3, 1)[0] == window_hashes(hashes, 3, 1)[3]
    same = sequence_hashes(hashes, np.array([0, 3]), np.array([3, 6]), 2)
    assert same[0] == same[1]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=40), min_size=1, max_size=5), st.integers(2, 9))
def test_equal_windows_have_equal_keys(texts, size):
    hashes = np.array([w for t in texts for w in t], np.uint64)
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    level = R.words_level(hashes, np.repeat(np.arange(len(texts)), np.diff(first)))
    keys = R.window_keys(hashes, [level, R.next_level(level, 1)], size)
    seen = {}
    for at in whole_windows(first, size):
        content = tuple(hashes[at : at + size])
        assert seen.setdefault(content, keys[at]) == keys[at]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60))
def test_symbols_stand_for_their_words(words):
    level = R.words_level(np.array(words, np.uint64), np.zeros(len(words), np.int64))
    names = {}
    for number in range(1, 7):
        level = R.next_level(level, number)
        assert level.start.tolist() == [0, *level.end.tolist()][: len(level.start)]
        for name, a, b in zip(level.name, level.start, level.end, strict=True):
            assert names.setdefault(name, words[a:b]) == words[a:b]
