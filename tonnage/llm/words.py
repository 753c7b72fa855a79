"""Words of UTF-8 texts as arrays: positions and 64-bit hashes, without a Python object per word.

Texts come in blocks of whole documents, so memory follows the block (a few MB) or the
longest single document, not the partition. Hashes are polynomials over a random table of
byte values, finished by a mixing function; equal words have equal hashes in every task.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 21
SLAB_BYTES = 1 << 19

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_SPACE = ~SPACE
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_TABLE = np.random.Generator(np.random.PCG64(20260101)).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 5
_U = np.uint64


def _powers(base: int, count: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate([np.ones(1, _U), np.full(count - 1, base, _U)]).cumprod(dtype=_U)


_POWER: dict[str, np.ndarray] = {}


def _tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWER.get("up", ())) < size:
        size = max(size, SLAB_BYTES + 1)
        _POWER["up"] = _powers(_BASE, size)
        _POWER["down"] = _powers(pow(_BASE, -1, 1 << 64), size)
    return _POWER["up"], _POWER["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> _U(30))
        x = x * _U(0xBF58476D1CE4E5B9)
        x = x ^ (x >> _U(27))
        x = x * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


@dataclass
class Texts:
    """Concatenated UTF-8 bytes of some texts; text i is data[offsets[i]:offsets[i + 1]]."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


@dataclass
class Words:
    """Byte range and hash of each word; the words of text i are first[i]:first[i + 1]."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    def text(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def texts_of(column: pa.Array) -> Texts:
    """The bytes of a string column; null counts as the empty text."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    if not len(column) or data is None:
        return Texts(np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64))
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return Texts(data, offsets - offsets[0])


def blocks(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES
) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Cut batches into runs of rows whose texts hold at most limit bytes, or one row.

    At the end the worker gives back what it no longer uses: it may stay idle beside others.
    """
    for batch in batches:
        texts = texts_of(batch.column(column))
        at = 0
        while at < len(texts):
            to = int(np.searchsorted(texts.offsets, texts.offsets[at] + limit, "right")) - 1
            to = min(max(to, at + 1), len(texts))
            a, b = texts.offsets[at], texts.offsets[to]
            yield batch.slice(at, to - at), Texts(texts.data[a:b], texts.offsets[at : to + 1] - a)
            at = to
    give_back_memory()


def give_back_memory() -> None:
    """Return freed memory, which the allocators would keep for this process, to the machine."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def hash_ranges(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each byte range; ranges are in order and do not overlap."""
    out = np.empty(len(start), _U)
    at = 0
    while at < len(start):
        to = max(int(np.searchsorted(end, start[at] + SLAB_BYTES, "right")), at + 1)
        a, b = int(start[at]), int(end[to - 1])
        up, down = _tables(b - a + 1)
        with np.errstate(over="ignore"):
            sums = np.zeros(b - a + 1, _U)
            np.cumsum(_TABLE[data[a:b]] * up[: b - a], out=sums[1:])
            s = start[at:to] - a
            out[at:to] = (sums[end[at:to] - a] - sums[s]) * down[s] + (end[at:to] - start[at:to]).astype(_U)
        at = to
    return mix(out)


def find_words(texts: Texts, member: np.ndarray = NOT_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each longest run of member bytes inside one text, and the first run of each text."""
    inside = np.zeros(len(texts.data) + 1, bool)
    inside[:-1] = member[texts.data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edge = texts.offsets[:-1]
    begins[edge] |= inside[edge]
    ends = np.zeros(len(inside), bool)
    ends[1:] = inside[:-1] & ~inside[1:]
    edge = texts.offsets[1:]
    edge = edge[edge > 0]
    ends[edge] |= inside[edge - 1]
    start, end = np.flatnonzero(begins[:-1]), np.flatnonzero(ends)
    return start, end, np.searchsorted(start, texts.offsets)


def words_of(texts: Texts, member: np.ndarray = NOT_SPACE, fold: np.ndarray | None = None) -> Words:
    """Words of each text: longest runs of member bytes, hashed after fold."""
    data = texts.data if fold is None else fold[texts.data]
    start, end, first = find_words(Texts(data, texts.offsets), member)
    return Words(start, end, hash_ranges(data, start, end), first)


def window_hashes(hashes: np.ndarray, size: int, seed: int) -> np.ndarray:
    """A 64-bit hash of each run of size hashes; windows may span texts, callers drop those."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, _U)
    with np.errstate(over="ignore"):
        words = mix(hashes + _U(seed))
        out = np.zeros(count, _U)
        for i in range(size):
            out = out * _U(_BASE) + words[i : i + count]
    return mix(out)


def whole_windows(first: np.ndarray, size: int) -> np.ndarray:
    """Start of each window of size words that lies inside one text."""
    total = int(first[-1])
    ok = np.ones(max(total - size + 1, 0), bool)
    for back in range(1, size):
        at = first[1:-1] - back
        at = at[(at >= 0) & (at < len(ok))]
        ok[at] = False
    return np.flatnonzero(ok)


def sequence_hashes(hashes: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of each range [start, end) of a sequence of hashes."""
    up, down = _tables(len(hashes) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(hashes) + 1, _U)
        np.cumsum(mix(hashes + _U(seed)) * up[: len(hashes)], out=sums[1:])
        return mix((sums[end] - sums[start]) * down[start] + np.asarray(end - start).astype(_U))
