"""Removal of word passages that also start in an earlier document, by recompression.

1. Every document is recompressed (see recompress). It reports the keys of its windows and
   its long symbols. Spark finds the names that two documents share, and the smallest
   document of each.
2. A long symbol shared with an earlier document settles all windows inside it. The other
   windows whose key is shared are sent, as 128-bit fingerprints, to be compared.
3. Each document drops the words of its settled windows.

Both comparisons aggregate before they shuffle and join the small result back, so a passage
that sits in a third of all documents is one row on one side, and Spark splits the other.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonnage.llm import recompress as R
from tonnage.llm.words import (
    Texts,
    blocks,
    find_words,
    sequence_hashes,
    texts_of,
    whole_windows,
    window_hashes,
    words_of,
)
from tonnage.sources.staging import stage, staged

WINDOW = 13
#: Rounds whose symbols anchor windows. Symbols of one round lie inside any window with all
#: that decided them, and stand close enough that more rounds only made more keys.
INNER_ROUNDS = 1
#: Rounds after which long symbols are reported: about 30 and 130 words, and the whole document.
OUTER_ROUNDS = 17
REPORTED = (12, 17)


class _Lists:
    """A list of 64-bit values for each text, asked for membership."""

    def __init__(self, column: pa.Array):
        lengths = _lengths(column)
        text = np.repeat(np.arange(len(lengths)), lengths)
        self.values, at = np.unique(np.asarray(column.flatten(), np.int64), return_inverse=True)
        self.pairs = np.unique(text * len(self.values) + at)

    def holds(self, text: np.ndarray, value: np.ndarray) -> np.ndarray:
        if not len(self.values):
            return np.zeros(len(value), bool)
        at = np.minimum(np.searchsorted(self.values, value), len(self.values) - 1)
        pair = text * len(self.values) + at
        place = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return (self.values[at] == value) & (self.pairs[place] == pair)


class _Parsed:
    """Windows and symbols of a block of texts."""

    def __init__(self, texts: Texts, size: int):
        self.words = words_of(texts)
        self.text = self.words.text()
        self.size = size
        levels = [R.words_level(self.words.hash, self.text)]
        for number in range(1, INNER_ROUNDS + 1):
            levels.append(R.next_level(levels[-1], number))
        self.at = whole_windows(self.words.first, size)
        self.keys = R.window_keys(self.words.hash, levels, size)[self.at].view(np.int64)
        whole = np.flatnonzero(np.diff(self.words.first) >= size)
        parts = R.repeat_symbols(levels[-1], range(INNER_ROUNDS + 1, OUTER_ROUNDS + 1), REPORTED, size)
        first, last = self.words.first[whole], self.words.first[whole + 1]
        parts.append((sequence_hashes(self.words.hash, first, last, 6), first, last))
        self.symbol, self.start, self.end = (np.concatenate(x) for x in zip(*parts, strict=True))
        self.check = sequence_hashes(self.words.hash, self.start, self.end, 7).view(np.int64)
        self.symbol = self.symbol.view(np.int64)

    def names(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, name and check of all keys (whose check is 0) and long symbols, each once a text."""
        text = self.text[self.at]
        new = np.ones(len(text), bool)
        new[1:] = (self.keys[1:] != self.keys[:-1]) | (text[1:] != text[:-1])
        text, key = text[new], self.keys[new]
        text = np.concatenate([text, self.text[self.start]])
        key = np.concatenate([key, self.symbol])
        check = np.concatenate([np.zeros(new.sum(), np.int64), self.check])
        order = np.lexsort((check, key, text))
        text, key, check = text[order], key[order], check[order]
        new = np.ones(len(text), bool)
        new[1:] = (text[1:] != text[:-1]) | (key[1:] != key[:-1]) | (check[1:] != check[:-1])
        return text[new], key[new], check[new]

    def settled(self, later: _Lists) -> np.ndarray:
        """Which windows lie inside a long symbol that an earlier document holds."""
        found = later.holds(self.text[self.start], self.symbol)
        return covered(self.start[found], self.end[found] - self.size + 1, len(self.words.start))[self.at]


def covered(start: np.ndarray, end: np.ndarray, size: int) -> np.ndarray:
    """Which of size places lie in one of the ranges [start, end)."""
    steps = np.zeros(size + 1, np.int64)
    np.add.at(steps, start, 1)
    np.add.at(steps, end, -1)
    return np.cumsum(steps[:-1]) > 0


def _report(size: int):
    """Rows (name, check, doc_id) of the documents in the batches."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches, "text"):
            text, key, check = _Parsed(texts, size).names()
            ids = batch.column("doc_id").take(pa.array(text))
            yield pa.record_batch({"name": pa.array(key), "check": pa.array(check), "doc_id": ids})

    return rows


def _open_windows(size: int):
    """Rows (one, two, doc_id): fingerprints of the windows that are still to be compared."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches, "text"):
            parsed = _Parsed(texts, size)
            text = parsed.text[parsed.at]
            later, shared = _Lists(batch.column("later")), _Lists(batch.column("shared"))
            ask = np.flatnonzero(shared.holds(text, parsed.keys) & ~parsed.settled(later))
            at, text = parsed.at[ask], text[ask]
            one = window_hashes(parsed.words.hash, size, 1)[at].view(np.int64)
            two = window_hashes(parsed.words.hash, size, 2)[at].view(np.int64)
            order = np.lexsort((two, one, text))
            text, one, two = text[order], one[order], two[order]
            new = np.ones(len(text), bool)
            new[1:] = (text[1:] != text[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1])
            ids = batch.column("doc_id").take(pa.array(text[new]))
            yield pa.record_batch({"one": pa.array(one[new]), "two": pa.array(two[new]), "doc_id": ids})

    return rows


def _without(size: int):
    """The documents without the words of their settled and matched windows."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches, "text"):
            start, end, first = find_words(texts)
            gone = np.zeros(len(start), bool)
            later, matched = batch.column("later"), batch.column("matched")
            some = np.flatnonzero(_lengths(later) + _lengths(matched))
            if len(some):
                part = texts_of(batch.column("text").take(pa.array(some)))
                parsed = _Parsed(part, size)
                one = window_hashes(parsed.words.hash, size, 1)[parsed.at].view(np.int64)
                hit = parsed.settled(_Lists(later.take(pa.array(some))))
                hit |= _Lists(matched.take(pa.array(some))).holds(parsed.text[parsed.at], one)
                at = parsed.at[hit]
                inside = np.concatenate([np.arange(first[i], first[i + 1]) for i in some])
                gone[inside] = covered(at, at + size, len(inside))
            kept, spans = [], []
            for i in range(len(texts)):
                a, b = first[i], first[i + 1]
                raw = texts.data[texts.offsets[i] : texts.offsets[i + 1]].tobytes()
                words = raw.split()
                if gone[a:b].any():
                    words = list(compress(words, (~gone[a:b]).tolist()))
                kept.append(b" ".join(words))
                edge = np.flatnonzero(np.diff(np.concatenate([[False], gone[a:b], [False]]).astype(np.int8)))
                spans.append([{"start": x, "end": y} for x, y in edge.reshape(-1, 2).tolist()])
            sums = np.concatenate([[0], np.cumsum(gone)])
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_words": pa.array(np.diff(first)),
                    "n_removed": pa.array(np.diff(sums[first])),
                    "kept": pa.array(kept, pa.binary()).cast(pa.string()),
                    "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                }
            )

    return rows


def _lengths(column: pa.Array) -> np.ndarray:
    return np.asarray(column.value_lengths().fill_null(0), np.int64)


def shared_names(docs: DataFrame, size: int) -> DataFrame:
    """Per document the names another document shares, and those an earlier document holds."""
    with staged(docs.mapInArrow(_report(size), "name long, check long, doc_id long")) as names:
        first = names.groupBy("name", "check").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
        first = first.where("least < most").drop("most")
        is_later = F.col("doc_id") > F.col("least")
        return stage(
            names.join(first, ["name", "check"])
            .groupBy("doc_id")
            .agg(
                F.collect_list(F.when((F.col("check") != 0) & is_later, F.col("name"))).alias("later"),
                F.collect_list(F.when(F.col("check") == 0, F.col("name"))).alias("shared"),
            )
        )


def matched_windows(docs: DataFrame, shared: DataFrame, size: int) -> DataFrame:
    """Per document the fingerprints of the compared windows that an earlier document holds."""
    asked = docs.join(shared, "doc_id").mapInArrow(_open_windows(size), "one long, two long, doc_id long")
    with staged(asked) as asked:
        first = asked.groupBy("one", "two").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
        first = first.where("least < most").drop("most")
        return stage(
            asked.join(first, ["one", "two"])
            .where(F.col("doc_id") > F.col("least"))
            .groupBy("doc_id")
            .agg(F.collect_list("one").alias("matched"))
        )


def remove_repeats(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """Documents without the passages of size or more words that an earlier document holds.

    Words are longest runs of non-blank characters. A word goes if a window of size words
    that covers it also starts in a document with a smaller doc_id; windows are those of the
    input, not of what is left. Returns one row per input row: doc_id, n_words, n_removed,
    kept (the remaining words joined by a space) and spans (word ranges that went).

    A null text has no words. A row without doc_id is before and after no other: it keeps
    all its words and takes none from others. Rows that share a doc_id are one document that
    takes nothing from itself. Other columns are ignored. Equality of windows and long
    symbols is that of 128-bit fingerprints.
    """
    docs = docs.select("doc_id", "text")
    known = docs.where("doc_id is not null and text is not null")
    shared = shared_names(known, size)
    matched = matched_windows(known, shared, size)
    found = shared.select("doc_id", "later").join(matched, "doc_id", "left")
    return docs.join(found, "doc_id", "left").mapInArrow(
        _without(size),
        "doc_id long, n_words long, n_removed long, kept string, spans array<struct<start: long, end: long>>",
    )
