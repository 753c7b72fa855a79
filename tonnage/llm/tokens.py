"""Token ids of documents in binary shards whose document boundaries are Elias-Fano coded.

A shard holds the ids of consecutive documents as one array of two- or four-byte integers,
and the documents' ends as a rising sequence: the low bits packed, the high bits in unary.
A sampled select finds the end of any document from these bits, so no table of 64-bit
offsets is stored. Shards are rows of a Parquet table, as Spark writes to any store.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tonnage.llm.words import Texts, blocks, hash_ranges, texts_of
from tonnage.sources.staging import shared_folder, shuffle_files_dropped

SHARD_IDS = 1 << 20
SHARD_DOCUMENTS = 1 << 16
SAMPLE = 256
#: Bytes of text that are encoded together.
ENCODED_BYTES = 1 << 20
MAGIC = b"TNG1"
HEADER = struct.Struct("<4sBBxxQQ")
SHARD_SCHEMA = "part int, shard int, start long, n_tokens long, doc_ids array<long>, payload binary"


class EliasFano:
    """A rising sequence of count values up to top, in about count * (2 + log2(top / count)) bits."""

    def __init__(self, count: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.count, self.low_bits, self.low, self.high, self.samples = count, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        count, top = len(values), int(values[-1]) if len(values) else 0
        bits = max(0, (top // count).bit_length() - 1) if count else 0
        low = np.packbits((values[:, None] >> np.arange(bits)) & 1 != 0, bitorder="little")
        ones = (values >> bits) + np.arange(count)
        high = np.zeros((top >> bits) + count + 1, bool)
        high[ones] = True
        return cls(count, bits, low, np.packbits(high, bitorder="little"), ones[::SAMPLE].astype("<u4"))

    def _low(self, start: int, end: int) -> np.ndarray:
        bits = self.low_bits
        first, last = start * bits // 8, (end * bits + 7) // 8
        flat = np.unpackbits(self.low[first:last], bitorder="little")[start * bits - 8 * first :]
        return flat[: (end - start) * bits].reshape(end - start, bits).astype(np.int64) @ (1 << np.arange(bits))

    def select(self, i: int) -> int:
        """The value at place i: only the bits from the sample before it up to it are read."""
        start = int(self.samples[i // SAMPLE])
        rest, byte, seen = i % SAMPLE, start // 8, 0
        skip = start - 8 * byte
        while True:
            ones = np.flatnonzero(np.unpackbits(self.high[byte : byte + 64], bitorder="little")[skip:]) + skip
            if seen + len(ones) > rest:
                place = 8 * byte + int(ones[rest - seen])
                return ((place - i) << self.low_bits) | int(self._low(i, i + 1)[0])
            seen, byte, skip = seen + len(ones), byte + 64, 0

    def values(self) -> np.ndarray:
        """All values in order."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))
        return ((ones - np.arange(self.count)) << self.low_bits) | self._low(0, self.count)


class Shard:
    """The documents of one payload."""

    def __init__(self, ids: np.ndarray, ends: EliasFano):
        self.ids, self.ends = ids, ends

    @classmethod
    def of(cls, ids: list[np.ndarray], kind: str) -> Shard:
        ends = np.cumsum([len(x) for x in ids])
        return cls(np.concatenate([np.zeros(0, kind), *ids]).astype(kind), EliasFano.of(ends))

    def to_bytes(self) -> bytes:
        ends = self.ends
        head = HEADER.pack(MAGIC, self.ids.itemsize, ends.low_bits, ends.count, len(self.ids))
        return b"".join([head, self.ids.tobytes(), ends.samples.tobytes(), ends.low.tobytes(), ends.high.tobytes()])

    @classmethod
    def from_bytes(cls, payload: bytes) -> Shard:
        magic, width, bits, count, total = HEADER.unpack_from(payload)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        at = HEADER.size
        ids = np.frombuffer(payload, f"<u{width}", total, at)
        at += total * width
        samples = np.frombuffer(payload, "<u4", -(-count // SAMPLE), at)
        at += samples.nbytes
        low = np.frombuffer(payload, np.uint8, (count * bits + 7) // 8, at)
        high = np.frombuffer(payload, np.uint8, -1, at + low.nbytes)
        return cls(ids, EliasFano(count, bits, low, high, samples))

    def bounds(self, i: int) -> tuple[int, int]:
        return self.ends.select(i - 1) if i else 0, self.ends.select(i)

    def document(self, i: int) -> np.ndarray:
        start, end = self.bounds(i)
        return self.ids[start:end]


class PieceTable:
    """Ids of pieces by their 64-bit hash and length, in arrays; emptied when it is full.

    A Python dictionary of as many pieces would take several times the memory and be slower.
    """

    BITS = 22
    MOST = 1_500_000

    def __init__(self, kind: str):
        self.kind = kind
        self.clear()

    def clear(self) -> None:
        size = 1 << self.BITS
        self.key = np.zeros(size, np.uint64)
        self.start = np.zeros(size, np.int32)
        self.count = np.zeros(size, np.int32)
        self.pool = np.zeros(1 << 16, self.kind)
        self.used = self.entries = 0

    def find(self, key: np.ndarray) -> np.ndarray:
        """The slot of each key, or -1."""
        slot = (key >> np.uint64(64 - self.BITS)).astype(np.int64)
        out = np.full(len(key), -1, np.int64)
        rest = np.arange(len(key))
        while len(rest):
            there = self.key[slot[rest]]
            same = there == key[rest]
            out[rest[same]] = slot[rest[same]]
            rest = rest[~same & (there != 0)]
            slot[rest] = (slot[rest] + 1) & ((1 << self.BITS) - 1)
        return out

    def add(self, key: np.ndarray, ids: list[np.ndarray]) -> None:
        """Enter distinct keys that are not there yet."""
        count = np.array([len(x) for x in ids], np.int64)
        start = self.used + np.cumsum(count) - count
        end = self.used + int(count.sum())
        if end > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(end, len(self.pool)), self.kind)])
        self.pool[self.used : end] = np.concatenate(ids)
        self.used, self.entries = end, self.entries + len(key)
        slot = (key >> np.uint64(64 - self.BITS)).astype(np.int64)
        rest = np.arange(len(key))
        while len(rest):
            free = rest[self.key[slot[rest]] == 0]
            # Of several keys that want a slot one gets it.
            self.key[slot[free]] = key[free]
            got = free[self.key[slot[free]] == key[free]]
            self.start[slot[got]], self.count[slot[got]] = start[got], count[got]
            done = np.zeros(len(key), bool)
            done[got] = True
            rest = rest[~done[rest]]
            slot[rest] = (slot[rest] + 1) & ((1 << self.BITS) - 1)

    def gather(self, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all slots one after another, and the count of each."""
        count = self.count[slot].astype(np.int64)
        shift = self.start[slot] - (np.cumsum(count) - count)
        return self.pool[np.repeat(shift, count) + np.arange(int(count.sum()))], count


class Encoder:
    """Ids of texts, equal to the tokenizer's own, with the ids of pieces remembered.

    A byte-level tokenizer first splits a text by a fixed pattern and encodes the pieces one
    by one. The split is done here on arrays and each new piece goes to the tokenizer once.
    Texts with characters other than white space, printable ASCII and Latin letters, texts
    with a special token, and all texts of other tokenizers are handed over whole.
    """

    TOGETHER = 400
    LETTER, DIGIT, SIGN, BLANK = range(4)
    CLASS = np.full(256, SIGN, np.uint8)
    CLASS[[9, 10, 13, 32]] = BLANK
    CLASS[0x30:0x3A] = DIGIT
    CLASS[0x41:0x5B] = CLASS[0x61:0x7B] = CLASS[0x80:] = LETTER

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = "<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"
        split = self.tokenizer.pre_tokenizer
        plain = type(split) is ByteLevel and split.use_regex and not split.add_prefix_space
        self.splits = plain and self.tokenizer.normalizer is None
        self.special = [x.content.encode() for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.table = PieceTable(self.kind)
        newline = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.newline = newline[0] if len(newline) == 1 else None

    def _raw(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, self.kind) for x in found]

    def _pieces(self, pieces: list[str]) -> list[np.ndarray]:
        """The ids of pieces; visible ones are encoded many at a time, with line ends between.

        A line end is a piece of its own there, and its id is in no visible piece.
        """
        if self.newline is None:
            return self._raw(pieces)
        ids: dict[str, np.ndarray] = {}
        visible = [x for x in pieces if not x.isspace()]
        groups = [visible[i : i + self.TOGETHER] for i in range(0, len(visible), self.TOGETHER)]
        for group, found in zip(groups, self._raw(["\n".join(g) for g in groups]), strict=True):
            cuts = np.flatnonzero(found == self.newline)
            if len(cuts) != len(group) - 1:
                ids.update(zip(group, self._raw(group), strict=True))
                continue
            starts, ends = [0, *(cuts + 1).tolist()], [*cuts.tolist(), len(found)]
            ids.update(zip(group, [found[a:b] for a, b in zip(starts, ends, strict=True)], strict=True))
        rest = [x for x in pieces if x not in ids]
        ids.update(zip(rest, self._raw(rest), strict=True))
        return [ids[x] for x in pieces]

    def _whole(self, texts: Texts) -> np.ndarray:
        """Which texts the tokenizer must split itself."""
        out = np.full(len(texts), not self.splits)
        if not self.splits or not len(texts.data):
            return out
        data, after = texts.data, np.append(texts.data[1:], 0)
        odd = (data < 0x20) & (self.CLASS[data] != self.BLANK) | (data == 0x7F) | (data == 0xC2) | (data > 0xC9)
        # The multiplication and division signs, and what lies beyond the Latin letters.
        odd |= (data == 0xC3) & ((after == 0x97) | (after == 0xB7)) | (data == 0xC9) & (after > 0x8F)
        at = [np.flatnonzero(odd)]
        raw = data.tobytes()
        for special in self.special:
            place = raw.find(special)
            while place >= 0:
                at.append(np.array([place]))
                place = raw.find(special, place + 1)
        out[np.searchsorted(texts.offsets, np.concatenate(at), "right") - 1] = True
        return out

    def _starts(self, texts: Texts) -> np.ndarray:
        """Where the pieces of texts begin; each ends where the next begins.

        Letters, digits and signs form runs, each with the blank before it. White space before a
        run leaves its last character to it if that is a blank, and else as a piece of its own.
        """
        data = texts.data
        kind = self.CLASS[data]
        new = np.ones(len(data), bool)
        new[1:] = kind[1:] != kind[:-1]
        edges = texts.offsets[:-1][np.diff(texts.offsets) > 0]
        new[edges] = True
        start = np.flatnonzero(new)
        end = np.append(start[1:], len(data))
        kind = kind[start]
        leads = np.zeros(len(data) + 1, bool)
        leads[edges] = True
        leads[-1] = True
        follows = ~leads[start]  # the run before is in the same text
        white = kind == self.BLANK
        before = np.append(False, white[:-1]) & follows  # white space before the run
        takes = before & ~white & (data[start - 1] == 0x20)
        gives = np.append(takes[1:], False)
        goes_on = np.append(follows[1:], False)
        out = np.zeros(len(data) + 1, bool)
        out[(start - takes)[~white]] = True
        out[start[white & (end - start > gives)]] = True
        out[end[white & ~gives & goes_on & (end - start > 1)] - 1] = True
        # An apostrophe that begins a piece takes certain letters after it.
        mark = (kind == self.SIGN) & (end - start == 1) & (data[start] == 0x27) & ~takes & goes_on
        mark = np.flatnonzero(mark & np.append(kind[1:] == self.LETTER, False))
        if len(mark):
            padded = np.append(data, [0, 0])
            one, two = padded[end[mark]], padded[end[mark] + 1]
            two = np.where(end[mark + 1] - end[mark] > 1, two, 0)
            pair = ((one == 0x72) | (one == 0x76)) & (two == 0x65) | (one == 0x6C) & (two == 0x6C)
            size = np.where(np.isin(one, [0x73, 0x74, 0x6D, 0x64]), 1, np.where(pair, 2, 0))
            mark, size = mark[size > 0], size[size > 0]
            out[end[mark]] = False
            # The rest of the letters is a piece of its own, unless nothing is left.
            out[end[mark] + size] = True
        return np.flatnonzero(out[:-1])

    def encode_block(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and where each text's begin and end."""
        whole = self._whole(texts)
        if whole.any():
            return self._mixed(texts, whole)
        if not len(texts.data):
            return np.zeros(0, self.kind), np.zeros(len(texts) + 1, np.int64)
        start = self._starts(texts)
        end = np.append(start[1:], len(texts.data))
        key = hash_ranges(texts.data, start, end) | np.uint64(1)
        if self.table.entries > self.table.MOST:
            self.table.clear()
        slot = self.table.find(key)
        lost = np.flatnonzero(slot < 0)
        if len(lost):
            new, at = np.unique(key[lost], return_index=True)
            at = lost[at]
            raw = texts.data.tobytes()
            pieces = [raw[a:b].decode() for a, b in zip(start[at].tolist(), end[at].tolist(), strict=True)]
            self.table.add(new, self._pieces(pieces))
            slot[lost] = self.table.find(key[lost])
        ids, count = self.table.gather(slot)
        sums = np.concatenate([[0], np.cumsum(count)])
        return ids, sums[np.searchsorted(start, texts.offsets)]

    def _mixed(self, texts: Texts, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        parts = [texts.data[texts.offsets[i] : texts.offsets[i + 1]] for i in range(len(texts))]
        rest = [p for p, w in zip(parts, whole, strict=True) if not w]
        sizes = np.cumsum([0] + [len(p) for p in rest])
        ids, edges = self.encode_block(Texts(np.concatenate([np.zeros(0, np.uint8), *rest]), sizes))
        split = iter([ids[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)])
        own = iter(self._raw([p.tobytes().decode() for p, w in zip(parts, whole, strict=True) if w]))
        found = [next(own) if w else next(split) for w in whole]
        return np.concatenate([np.zeros(0, self.kind), *found]), np.cumsum([0] + [len(x) for x in found])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        ids, edges = self.encode_block(texts_of(pa.array(texts, pa.string())))
        return [ids[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _shards(path: str, end_id: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, start = TaskContext.get().partitionId(), 0, 0
        code = encoder(path)
        held: list[np.ndarray] = []
        ends: list[np.ndarray] = []
        names: list[pa.Array] = []
        size = 0

        def shard() -> pa.RecordBatch:
            payload = Shard(np.concatenate(held), EliasFano.of(np.concatenate(ends))).to_bytes()
            ids = pa.concat_arrays(names)
            ids = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
            place = [pa.array([part], pa.int32()), pa.array([number], pa.int32())]
            columns = [*place, pa.array([start]), pa.array([size]), ids, pa.array([payload])]
            return pa.record_batch(columns, [x.split()[0] for x in SHARD_SCHEMA.split(", ")])

        try:
            for batch, texts in blocks(batches, "text", ENCODED_BYTES):
                ids, edges = code.encode_block(texts)
                edges = edges + np.arange(len(edges))
                out = np.empty(len(ids) + len(texts), code.kind)
                last = np.zeros(len(out), bool)
                last[edges[1:] - 1] = True
                out[last], out[~last] = end_id, ids
                held.append(out)
                ends.append(size + edges[1:])
                names.append(batch.column("doc_id").cast(pa.int64()))
                size += len(out)
                if size >= SHARD_IDS or sum(map(len, names)) >= SHARD_DOCUMENTS:
                    yield shard()
                    number, start, held, ends, names, size = number + 1, start + size, [], [], [], 0
            if held:
                yield shard()
        finally:
            # The worker may go on to tasks that need no pieces.
            code.table.clear()

    return rows


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int, path: str | None = None) -> str:
    """Write the ids of docs (doc_id, text) in ascending doc_id order as shards and return their folder.

    Each text is encoded whole, without the tokenizer's special frame, and followed by end_id.
    A null text is empty and yields end_id alone; a null doc_id comes first; rows that share a
    doc_id are ordered by text. The default folder lies in the shared folder of the session.
    A shard ends with the block of documents that fills it, so tasks hold one shard and one block.
    """
    spark = docs.sparkSession
    path = path or f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    text = docs.select("doc_id", "text")
    lined = text.repartitionByRange(F.col("doc_id")).sortWithinPartitions("doc_id", "text")
    with shuffle_files_dropped(spark):
        lined.mapInArrow(_shards(tokenizer, end_id), SHARD_SCHEMA).write.option("compression", "zstd").parquet(path)
    return path


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            part, start, names, payload = (batch.column(c)[row] for c in ("part", "start", "doc_ids", "payload"))
            shard = Shard.from_bytes(payload.as_buffer())
            ends = shard.ends.values()
            starts = np.concatenate([[0], ends[:-1]])
            bounds = zip(starts.tolist(), ends.tolist(), strict=True)
            sums = [zlib.crc32(shard.ids[a:b].astype("<u4").tobytes()) for a, b in bounds]
            yield pa.record_batch(
                {
                    "part": pa.array(np.full(len(ends), part.as_py(), np.int32)),
                    "doc_id": names.values,
                    "start": pa.array(starts + start.as_py()),
                    "n_tokens": pa.array(ends - starts),
                    "ids_crc32": pa.array(sums, pa.int64()),
                }
            )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """What the shards in path hold, one row per document: doc_id, start, n_tokens, ids_crc32.

    start counts the ids of all documents before it; the checksum is that of the ids as
    little-endian 32-bit integers. Empty folders of shards give no rows.
    """
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    found = shards.select("part", "start", "doc_ids", "payload").mapInArrow(
        _documents, "part int, doc_id long, start long, n_tokens long, ids_crc32 long"
    )
    # One row per written partition, so the running total is small.
    totals = shards.groupBy(F.col("part").alias("of")).agg(F.sum("n_tokens").alias("total"))
    before = F.sum("total").over(W.orderBy("of").rowsBetween(W.unboundedPreceding, -1))
    totals = totals.select("of", F.coalesce(before, F.lit(0)).alias("before"))
    return found.join(totals, F.col("part") == F.col("of")).select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )
