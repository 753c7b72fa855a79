"""Licence notices, by a generalised suffix automaton of licence words.

The automaton accepts every word sequence of every template. A text is streamed through it, which
gives at each word the longest sequence ending there that some template holds: its matching
statistics. Long matches that go on in the same template order are chained over small gaps, such
as names and years, and a chain that covers enough of a template is a notice of that licence.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tonnage.llm.words import LOWER, Texts, blocks, hash_ranges, find_words

# Phrases that name a licence by themselves.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Notices of public licences.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc0", "To the extent possible under law the person who associated CC0 with this work has waived all copyright and related or neighboring rights to this work"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
)

#: Words of a match that counts, words that a chain may skip, and the covered share that makes a notice.
LEAST_MATCH = 4
GAP = 12
COVERED = 0.8

WORD = np.zeros(256, bool)
WORD[0x30:0x3A] = WORD[0x61:0x7B] = WORD[0x80:] = True


def _words(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text, lower-cased A-Z, and each text's first."""
    data = LOWER[texts.data]
    start, end, first = find_words(Texts(data, texts.offsets), WORD)
    return hash_ranges(data, start, end), first


def _hashes(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    return _words(Texts(raw, np.array([0, len(raw)])))[0]


class SuffixAutomaton:
    """The least automaton of all subsequences of neighbouring words of some word lists."""

    def __init__(self, lists: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.ends: list[list[tuple[int, int]]] = [[]]
        for number, words in enumerate(lists):
            last = 0
            for place, word in enumerate(words):
                last = self._extend(last, word)
                self.ends[last].append((number, place + 1))
        # What ends at a state's sequence also ends at every shorter suffix of it.
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.ends[self.link[state]] += self.ends[state]

    def _state(self, length: int, link: int, follow: dict[int, int]) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        self.ends.append([])
        return len(self.link) - 1

    def _split(self, before: int, word: int) -> int:
        """The state of before's sequence and word, apart from longer sequences of the same state."""
        state = self.next[before][word]
        if self.length[state] == self.length[before] + 1:
            return state
        copy = self._state(self.length[before] + 1, self.link[state], dict(self.next[state]))
        self.link[state] = copy
        while before >= 0 and self.next[before].get(word) == state:
            self.next[before][word] = copy
            before = self.link[before]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, word)
        new = self._state(self.length[last] + 1, 0, {})
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, word)
        return new

    def matches(self, words: list[int], least: int) -> Iterator[tuple[int, int, int]]:
        """(end, length, state) of each match of least or more words that the next word does not extend."""
        state, length = 0, 0
        for at, word in enumerate(words):
            if word not in self.next[state] and length >= least:
                yield at, length, state
            while state > 0 and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                length += 1
            else:
                length = 0
        if length >= least:
            yield len(words), length, state


@dataclass
class _Chain:
    """The best chain that ends with one match; first is the match that it begins with."""

    first: int
    start: int
    end: int
    of_end: int
    covered: int


class Scanner:
    """Finds phrases and notices in texts given as word hashes."""

    def __init__(self, templates: tuple[tuple[str, str], ...], phrases: tuple[tuple[str, str], ...]):
        self.labels = [label for label, _ in templates]
        hashed = [_hashes(text) for _, text in templates]
        self.phrases = [(label, _hashes(text)) for text, label in phrases]
        self.vocabulary = np.unique(np.concatenate(hashed))
        lists = [np.searchsorted(self.vocabulary, h).tolist() for h in hashed]
        self.sizes = [len(x) for x in lists]
        self.automaton = SuffixAutomaton(lists)

    def places(self, hashes: np.ndarray, first: np.ndarray) -> list[tuple[str, np.ndarray]]:
        """Per phrase its label and the words at which it begins, inside one text."""
        out = []
        for label, phrase in self.phrases:
            here = np.ones(max(len(hashes) - len(phrase) + 1, 0), bool)
            for i, word in enumerate(phrase):
                here &= hashes[i : len(hashes) - len(phrase) + 1 + i] == word
            at = np.flatnonzero(here)
            text = np.searchsorted(first, at, "right") - 1
            out.append((label, at[at + len(phrase) <= first[text + 1]]))
        return out

    def known_runs(self, hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, list[int]]]:
        """(text, first word, word numbers) of each run of template words that may hold a match."""
        if not len(hashes):
            return
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        known = np.concatenate([[False], self.vocabulary[at] == hashes, [False]])
        turn = known[1:] != known[:-1]
        edge = first[(first > 0) & (first < len(hashes))]
        turn[edge] |= known[edge] & known[edge + 1]
        cuts = np.flatnonzero(turn)
        begin, end = cuts, np.append(cuts[1:], len(hashes))
        run = known[begin + 1] if len(begin) else np.zeros(0, bool)
        keep = run & (end - begin >= LEAST_MATCH)
        text = np.searchsorted(first, begin, "right") - 1
        for t, a, b in zip(text[keep].tolist(), begin[keep].tolist(), end[keep].tolist(), strict=True):
            yield t, a, at[a:b].tolist()

    def notices(self, runs: list[tuple[int, list[int]]]) -> list[tuple[int, int, int, float]]:
        """(template, start, end, covered share) of the best chain of each template and first match.

        Every match takes the best of all chains that it can go on, and leaves them as they are for
        others. Matches come by their ends, so those within GAP of a match are the last ones.
        """
        chains: dict[int, list[_Chain]] = {}
        for base, words in runs:
            for end, length, state in self.automaton.matches(words, LEAST_MATCH):
                for template, of_end in self.automaton.ends[state]:
                    start, stop, of_start = base + end - length, base + end, of_end - length
                    mine = chains.setdefault(template, [])
                    best = _Chain(len(mine), start, stop, of_end, length)
                    for chain in reversed(mine):
                        if start - chain.end > GAP:
                            break
                        # A match may begin inside the chain, in the text and in the template alike.
                        over = max(chain.end - start, chain.of_end - of_start, 0)
                        onward = stop > chain.end and of_end > chain.of_end
                        covered = chain.covered + length - over
                        if onward and over < length and covered > best.covered:
                            best = _Chain(chain.first, chain.start, stop, of_end, covered)
                    mine.append(best)
        found = []
        for template, many in chains.items():
            longest: dict[int, _Chain] = {}
            for chain in many:
                if chain.first not in longest or chain.covered > longest[chain.first].covered:
                    longest[chain.first] = chain
            found += [(template, c.start, c.end, c.covered / self.sizes[template]) for c in longest.values()]
        return sorted(found)


@lru_cache(maxsize=2)
def scanner(templates: tuple = TEMPLATES, phrases: tuple = PHRASES) -> Scanner:
    return Scanner(templates, phrases)


COLUMNS = {
    "n_words": "long",
    "n_base": "long",
    "first_word": "long",
    "last_word": "long",
    "base_labels": "string",
    "labels": "string",
    "score": "double",
    "spans": "array<struct<label: string, start: long, end: long, covered: double>>",
}

_SPAN = [("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("covered", pa.float64())]
_TYPES = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
ARROW = {c: _TYPES.get(k, pa.list_(pa.struct(_SPAN))) for c, k in COLUMNS.items()}


def _scan(templates: tuple, phrases: tuple):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(templates, phrases)
        for batch, texts in blocks(batches, "text"):
            hashes, first = _words(texts)
            count = len(texts)
            base: list[list[tuple[int, str]]] = [[] for _ in range(count)]
            for label, at in scan.places(hashes, first):
                for text, place in zip((np.searchsorted(first, at, "right") - 1).tolist(), at.tolist(), strict=True):
                    base[text].append((place - int(first[text]), label))
            runs: dict[int, list[tuple[int, list[int]]]] = {}
            for text, start, words in scan.known_runs(hashes, first):
                runs.setdefault(text, []).append((start - int(first[text]), words))
            out: dict[str, list] = {c: [] for c in COLUMNS}
            for i in range(count):
                notices = scan.notices(runs[i]) if i in runs else []
                spans = [
                    {"label": scan.labels[t], "start": a, "end": b, "covered": share}
                    for t, a, b, share in notices
                    if share >= COVERED
                ]
                places, named = [p for p, _ in base[i]], {x for _, x in base[i]}
                labels = named | {s["label"] for s in spans}
                best = max([1.0] if named else [share for *_, share in notices], default=0.0)
                row = (
                    int(first[i + 1] - first[i]),
                    len(places),
                    min(places, default=None),
                    max(places, default=None),
                    ",".join(sorted(named)),
                    ",".join(sorted(labels)),
                    min(best, 1.0),
                    spans,
                )
                for column, value in zip(out.values(), row, strict=True):
                    column.append(value)
            columns = {c: pa.array(v, ARROW[c]) for c, v in out.items()}
            yield pa.record_batch({"doc_id": batch.column("doc_id")} | columns)

    return rows


def scan_licences(docs: DataFrame, templates: tuple = TEMPLATES, phrases: tuple = PHRASES) -> DataFrame:
    """doc_id with the places of licence phrases and the notices of each row's text.

    Words are longest runs of a-z (A-Z lower-cased), 0-9 and characters beyond ASCII. n_base counts
    the places of all phrases, first_word and last_word are the least and greatest of them (null
    without any), base_labels names the phrases' licences. labels adds those of notices: chains of
    matches of 4 words or more, at most 12 words apart, that cover 80 in 100 of a template; spans has
    them in words. score is 1 with a phrase, else the largest covered share of a template, 0 without
    a match. A null text counts as empty. Rows are scanned one by one; other columns are ignored.
    """
    schema = ", ".join(["doc_id long", *(f"{c} {k}" for c, k in COLUMNS.items())])
    return docs.select("doc_id", "text").mapInArrow(_scan(templates, phrases), schema)
