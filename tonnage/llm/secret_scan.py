"""Secrets in texts: fixed patterns, and assignments whose target is sensitive.

The lexer reads source code and configuration as pairs of a name and an expression of literals
and names. Values known from earlier pairs replace names, so a literal that reaches a sensitive
name over other names is judged by that name. A literal's score is how sensitive the name is
times how much the literal looks like a secret; one that is a placeholder or a reference as a
whole scores 0.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tonnage.llm.words import Texts, blocks, find_words

# The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "literal")
LEAST_ASSIGNED, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

#: Score from which a literal is reported.
REPORT = 0.5
# How sensitive a name is, by the most telling word in it.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 1.0, "pass": 0.8, "secret": 1.0, "secrets": 1.0,
    "token": 0.9, "apikey": 1.0, "credential": 1.0, "credentials": 1.0, "creds": 1.0, "auth": 0.7, "bearer": 0.9,
    "authorization": 0.8, "signature": 0.6, "privatekey": 1.0, "accesskey": 1.0, "secretkey": 1.0,
}
# Words that make a key a secret one, and words that make a name harmless.
KEY_OWNERS = {"api", "access", "private", "secret", "encryption", "signing", "ssh", "master", "account", "auth", "client"}
HARMLESS = {"type", "count", "max", "min", "length", "size", "limit", "name", "field", "label", "url", "uri", "path", "file", "public", "expires", "expiry", "hint"}
# Words that stand for a value, and words that may follow them.
STAND_INS = {"your", "my", "changeme", "change", "me", "example", "sample", "dummy", "test", "none", "null", "true", "false", "todo", "undefined", "redacted"}
FOLLOWERS = STAND_INS | set(SENSITIVE) | KEY_OWNERS | HARMLESS | {"key", "keys", "here", "value", "goes", "the", "a", "an", "id", "user", "username", "app", "db", "database", "string", "this", "in", "it", "to", "is"}


def _either(words: set[str]) -> str:
    return "|".join(sorted(words, key=lambda w: (-len(w), w)))


#: A whole value of filling characters, or of a word that stands for a value and words after it.
PLACEHOLDER = re.compile(rf"(?i:[x*._ -]+|[_. -]*(?:{_either(STAND_INS)})(?:[_. -]*+(?>{_either(FOLLOWERS)}))*+[_. -]*)")
#: Values taken from elsewhere, by their full syntax: ${name}, $(command), %(name)s, {{name}}, <% name %>; $NAME
#: as a word; {name} and <name> without digits, or as the whole value, as %NAME% is.
REFERENCE = re.compile(
    r"""\$?\{\{[^{}]*+\}\}|[$\#]\{(?:[\w./\[\]\x20]|:(?![-=?+]))*+\}|\$\([^()]*+\)|%\([^()]*+\)[sd]|<%[^<>%]*+%>"""
    r"""|(?:\A|(?<=\s))\$[A-Z_][A-Z0-9_]*+(?=\s|\Z)|\{[A-Za-z_.]*+\}|<[A-Za-z][A-Za-z_\x20.:-]*+>"""
    r"""|\A(?:\{[\w.]*+\}|<[A-Za-z][\w\x20.:-]*+>|%[A-Z_][A-Z0-9_]*+%|%[sd])\Z"""
)

#: Names that hold several words.
PHRASES = {"passphrase", "phrase", "mnemonic", "seed"}

# Repeats are possessive: they take all there is and never give back, so no length needs a bound.
NAME = r"[A-Za-z_][A-Za-z0-9_.-]*+"
LITERAL = r""""(?:[^"\\\n]++|\\.)*+"|'(?:[^'\\\n]++|\\.)*+'"""
OPERAND = rf"(?:{LITERAL}|[A-Za-z0-9_][A-Za-z0-9_./+=-]*+)"
GIVES = r"(?:=>|:=|=(?![=>])|:(?![:=/]))"
# A name on a later line that is itself given a value is no value.
GAP = rf"""(?:[^\S\n]*+(?!\n)|\s*+(?!["']?{NAME}["']?[^\S\n]*+{GIVES}))"""
PAIR = re.compile(
    rf"""(?<![A-Za-z0-9_.-])["']?(?P<name>{NAME})["']?\s*+{GIVES}{GAP}(?P<value>{OPERAND}(?:\s*+\+\s*+{OPERAND})*+)"""
)
PARTS = re.compile(OPERAND)
HEX_BYTE = np.zeros(256, bool)
HEX_BYTE[0x30:0x3A] = HEX_BYTE[0x61:0x67] = True


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, leftmost and not overlapping within a kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGNED]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= LEAST_HEX]
    return sorted(found)


def name_words(name: str) -> list[str]:
    """Words of a name, split at marks and at changes to upper case."""
    return [w.lower() for w in re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+", name)]


def sensitivity(name: str) -> float:
    """How likely a name holds a secret, 0 to 1."""
    words = name_words(name)
    most = max((SENSITIVE.get(w, 0.0) for w in words), default=0.0)
    if "key" in words and KEY_OWNERS & set(words):
        most = 1.0
    return 0.3 * most if HARMLESS & set(words) else most


def own_part(literal: str) -> str:
    """What a literal gives itself: nothing if a placeholder, else without references to other values.

    Beside a reference only pieces with a digit count, as the rest is the frame of a template.
    """
    if PLACEHOLDER.fullmatch(literal):
        return ""
    pieces = REFERENCE.split(literal)
    return literal if len(pieces) == 1 else "".join(p for p in pieces if any(c.isdigit() for c in p))


def secrecy(counts: Counter[str], phrase: bool = False) -> float:
    """How much the characters of a literal look like a secret, 0 to 1: many and varied.

    More than two blanks make prose of it, unless it is meant to be a phrase.
    """
    size = counts.total()
    if size < LEAST_ASSIGNED or counts[" "] > 2 and not phrase:
        return 0.0
    shares = [n / size for n in counts.values()]
    entropy = -sum(p * math.log2(p) for p in shares)
    letters = "".join(counts)
    kinds = sum(bool(re.search(k, letters)) for k in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return min(1.0, 0.25 * min(entropy / 3.0, 2.0) + 0.15 * kinds + 0.02 * min(size, 20))


@dataclass(eq=False, slots=True)
class Value:
    """What a name holds: literals of its own and the values of other names; characters once asked for."""

    places: list[tuple[int, int]]
    of: list[Value]
    counts: Counter[str] | None = None
    score: float = 0.0


NOTHING = Value([], [])


def _characters(text: str, value: Value) -> Counter[str]:
    """Characters of the literals of a value, each literal once."""
    chain = []
    while value.counts is None and len(value.of) == 1:
        chain.append(value)
        value = value.of[0]
    if value.counts is None:
        counts: Counter[str] = Counter()
        stack, seen = [value], set()
        while stack:
            part = stack.pop()
            if id(part) not in seen:
                seen.add(id(part))
                stack += part.of
                for a, b in part.places:
                    counts.update(own_part(text[a:b]))
        value.counts = counts
    counts = value.counts.copy() if chain else value.counts
    for left in range(len(chain) - 1, -1, -1):
        for a, b in chain[left].places:
            counts.update(own_part(text[a:b]))
        # Others may use the last names of a chain, or any: keep some on the way.
        if left < 2 or left % 64 == 0:
            chain[left].counts = counts.copy()
    return counts


def literal_spans(text: str) -> list[tuple[int, int, float]]:
    """(start, end, score) of literals that an assignment gives to a sensitive name."""
    values: dict[str, Value] = {}
    order: list[Value] = []
    for pair in PAIR.finditer(text):
        name = pair["name"].rpartition(".")[2].lower()
        places: list[tuple[int, int]] = []
        of: dict[int, Value] = {}
        for part in PARTS.finditer(text, pair.start("value"), pair.end("value")):
            quoted = part[0][0] in "\"'"
            word = part[0].rpartition(".")[2].lower()
            if quoted:
                places.append((part.start() + 1, part.end() - 1))
            elif word in values:
                of[id(values[word])] = values[word]
            elif any(c.isdigit() for c in part[0]):
                places.append(part.span())
        of.pop(id(NOTHING), None)
        if not places and not of:
            values[name] = NOTHING
            continue
        value = values[name] = Value(places, list(of.values()))
        order.append(value)
        # A literal put together from several is as secret as the whole is.
        if level := sensitivity(pair["name"]):
            value.score = level * secrecy(_characters(text, value), bool(PHRASES & set(name_words(pair["name"]))))
    # A value is made of earlier ones only, so from the last on each is done before its parts.
    found: list[tuple[int, int, float]] = []
    for value in reversed(order):
        for part in value.of:
            part.score = max(part.score, value.score)
        found += [(a, b, value.score) for a, b in value.places if value.score >= REPORT and b > a]
    return sorted(found)


def apart(spans: list[tuple[int, int, float]], base: list[tuple[int, int, int]]) -> list[tuple[int, int, float]]:
    """The spans (start, end, score) that touch none of base (start, kind, end), which is in order of starts."""
    starts = [a for a, _, _ in base]
    # Of the base spans that begin before a span's end, one reaches it if the furthest does.
    furthest = [0, *accumulate((b for _, _, b in base), max)]
    return [x for x in spans if furthest[bisect_left(starts, x[1])] <= x[0]]


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, kind, b in sorted(spans))


def _marked(texts: Texts) -> np.ndarray:
    """Texts with a mark of an assignment, an access key or a long run of hexadecimal digits."""
    marks = np.zeros(len(texts), bool)
    at = np.flatnonzero((texts.data == 0x3D) | (texts.data == 0x3A))
    start, end, _ = find_words(texts, HEX_BYTE)
    at = np.concatenate([at, start[end - start >= LEAST_HEX]])
    data = texts.data
    if len(data) > 3:
        key = (data[:-3] == 65) & (data[1:-2] == 75) & (data[2:-1] == 73) & (data[3:] == 65)
        at = np.concatenate([at, np.flatnonzero(key)])
    marks[np.searchsorted(texts.offsets, at, "right") - 1] = True
    return marks


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in blocks(batches, "text"):
        marks = _marked(texts)
        out: dict[str, list] = {c: [] for c in ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "top_score")}
        for i in range(len(texts)):
            base: list[tuple[int, int, int]] = []
            literals: list[tuple[int, int, float]] = []
            if marks[i]:
                text = batch.column("text")[i].as_py()
                base = base_spans(text)
                literals = apart(literal_spans(text), base)
            kinds = Counter(kind for _, kind, _ in base)
            spans = base + [(a, 3, b) for a, b, _ in literals]
            digest = hashlib.sha256(_joined(base).encode()).hexdigest()
            row = (kinds[0], kinds[1], kinds[2], digest, _joined(spans), max((s for *_, s in literals), default=0.0))
            for column, value in zip(out.values(), row, strict=True):
                column.append(value)
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64())
        columns = {c: pa.array(v, k) for (c, v), k in zip(out.items(), types, strict=True)}
        yield pa.record_batch({"doc_id": batch.column("doc_id")} | columns)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """doc_id with the secrets of each row's text.

    n_assign, n_access and n_hex count the base patterns, base_sha256 is the digest of their spans
    kind:start:end, in code points, joined by commas. spans adds, as kind literal, the literals that
    reach a sensitive name and touch no base span; top_score is the greatest of their scores, else 0.
    A literal with more than two blanks counts as prose, unless its name asks for a phrase. Time
    follows the length of a text.
    A null text counts as empty. Rows are scanned one by one; other columns are ignored.
    """
    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, top_score double"
    return docs.select("doc_id", "text").mapInArrow(_scan, schema)
