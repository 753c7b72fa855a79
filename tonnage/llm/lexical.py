"""Ranked lexical search over an inverted index, by a hybrid of term-at-a-time and document-at-a-time.

The index is a table of postings, cut into segments of some MB of text that are indexed and searched
each by itself. In a segment, an item's short lists are summed term by term into accumulators. These
then stand as one more list, with their greatest sum as its bound, beside the long lists, and all are
passed document by document: lists whose bounds together stay below the least score of the best
documents so far propose no document, and are only looked up for those that the others propose.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tonnage.llm.words import LOWER, Texts, blocks, find_words
from tonnage.sources.staging import stage, staged

#: Text in a segment, unless one document has more, and documents in it, whose numbers take 16 bits.
SEGMENT_BYTES = 1 << 23
SEGMENT_DOCUMENTS = 1 << 16
#: Items that meet a segment in one task.
ITEMS = 1 << 10
#: A list is short if it names at most one in so many documents of its segment.
SHORT = 16
#: Documents passed between two looks at the least score of the best.
STRIDE = 1 << 10

#: Bytes of terms: letters and digits of ASCII, and all characters beyond ASCII.
TERM = np.zeros(256, bool)
TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
TERM_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: The row of a segment that has no term holds its documents: their ids and their sizes.
DOCUMENTS = ""
INDEX_SCHEMA = "segment long, term string, df long, total long, docs binary, counts binary"


def _terms(texts: Texts) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """For each term of the texts its number, what the numbers stand for, and each text's first term."""
    data = LOWER[texts.data]
    start, end, first = find_words(Texts(data, texts.offsets), TERM)
    ends = np.concatenate([[0], np.cumsum(end - start)])
    # Between two terms stand only other bytes, so the terms' bytes are all that remain.
    buffers = [None, pa.py_buffer(ends), pa.py_buffer(data[TERM[data]])]
    coded = pa.Array.from_buffers(pa.large_string(), len(start), buffers).dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary, first


def _slices(raw: np.ndarray, edges: np.ndarray) -> pa.Array:
    """A binary array of the ranges of raw between neighbouring edges, counted in its items."""
    bounds = pa.py_buffer((edges * raw.itemsize).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, bounds, pa.py_buffer(raw.tobytes())])


def _segment(number: int, doc_ids: pa.Array, texts: Texts) -> pa.RecordBatch:
    """The rows of one segment: its documents in order of their ids, null last, and a list for each term."""
    order = pc.sort_indices(doc_ids, null_placement="at_end").to_numpy().astype(np.int64)
    local = np.empty(len(order), np.int64)
    local[order] = np.arange(len(order))
    term, names, first = _terms(texts)
    size = np.diff(first)
    key = np.sort(term * len(order) + np.repeat(local, size))
    begins = np.flatnonzero(np.diff(key, prepend=-1))
    count = np.diff(begins, append=len(key))
    docs, term = key[begins] % len(order), key[begins] // len(order)
    edges = np.searchsorted(term, np.arange(len(names) + 1))
    lists = {
        "term": names.cast(pa.string()),
        "df": pa.array(np.diff(edges)),
        "total": pa.array(np.diff(np.concatenate([[0], np.cumsum(count)])[edges])),
        "docs": _slices(docs.astype("<u2"), edges),
        "counts": _slices(count.astype("<u4"), edges),
    }
    ids = doc_ids.take(pa.array(order)).drop_null().to_numpy().astype("<i8")
    own = {
        "term": pa.array([DOCUMENTS]),
        "df": pa.array([int((size > 0).sum())]),
        "total": pa.array([int(size.sum())]),
        "docs": pa.array([ids.tobytes()], pa.binary()),
        "counts": pa.array([size[order].astype("<u8").tobytes()], pa.binary()),
    }
    columns = {c: pa.concat_arrays([own[c], lists[c]]) for c in own}
    return pa.record_batch({"segment": pa.array(np.full(len(names) + 1, number))} | columns)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    for batch, texts in blocks(batches, "text", SEGMENT_BYTES):
        ids = batch.column("doc_id").cast(pa.int64())
        for low in range(0, len(texts), SEGMENT_DOCUMENTS):
            edges = texts.offsets[low : low + SEGMENT_DOCUMENTS + 1]
            part = Texts(texts.data[edges[0] : edges[-1]], edges - edges[0])
            yield _segment(number, ids.slice(low, len(part)), part)
            number += 1


def index_documents(docs: DataFrame) -> DataFrame:
    """The postings of docs (doc_id, text): a lazy table of one row per segment and term.

    Terms are longest runs of letters and digits of ASCII and of all characters beyond it, in the
    whole text, A-Z lower-cased; a null or empty text has none. df counts a list's documents and total its
    occurrences; docs and counts hold them, the documents by their number in the segment. Terms
    are told apart by their characters, not by hashes. The row without a term lists the segment's
    documents. A row without doc_id is indexed like others, and so is each of several equal rows;
    other columns are ignored. A task holds a segment and the lists made of it: some ten times
    SEGMENT_BYTES, or of the longest single text. To be staged before it is searched.
    """
    return docs.select("doc_id", "text").mapInArrow(_segments, INDEX_SCHEMA)


@dataclass
class List:
    """The documents of a term in a segment, ascending, what each gains by it, and the most that any gains."""

    docs: np.ndarray
    gain: np.ndarray
    most: int


def accumulate(lists: list[List], documents: int) -> List:
    """One list of the sums of several, worked out term by term."""
    sums = np.zeros(documents, np.int64)
    for x in lists:
        sums[x.docs] += x.gain
    docs = np.flatnonzero(sums)
    return List(docs, sums[docs], int(sums.max(initial=0)))


def _best(docs: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k of highest score, and of equal ones those of lower number."""
    if len(docs) > 4 * k:
        enough = score >= np.partition(score, len(score) - k)[len(score) - k]
        docs, score = docs[enough], score[enough]
    order = np.lexsort((docs, -score))[:k]
    return docs[order], score[order]


def best_documents(lists: list[List], documents: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and scores of the k documents with the highest sums over lists, ties by lower number."""
    short = [x for x in lists if SHORT * len(x.docs) <= documents]
    long = [x for x in lists if SHORT * len(x.docs) > documents]
    summed = accumulate(short, documents)
    if not long:
        return _best(summed.docs, summed.gain, k)
    passed = sorted([x for x in [summed, *long] if x.most], key=lambda x: x.most)
    # bound[i] is the most that the first i lists give to a document together.
    bound = np.cumsum([0] + [x.most for x in passed])
    # A partial sum is a score's lower bound, so k of them bound the k-th best score.
    least = int(np.partition(summed.gain, -k)[-k]) if len(summed.gain) >= k else 1
    docs, score = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for low in range(0, documents, STRIDE):
        high = min(low + STRIDE, documents)
        # Documents that only the first lists name score below the best k: equal scores stay.
        idle = int(np.searchsorted(bound, least, "left")) - 1
        sums = np.zeros(high - low, np.int64)
        for x in passed[idle:]:
            a, b = np.searchsorted(x.docs, (low, high))
            sums[x.docs[a:b] - low] += x.gain[a:b]
        found = np.flatnonzero(sums)
        sums, found = sums[found], found + low
        for i in range(idle - 1, -1, -1):
            hopeful = sums + bound[i + 1] >= least
            sums, found = sums[hopeful], found[hopeful]
            x = passed[i]
            at = np.minimum(np.searchsorted(x.docs, found), len(x.docs) - 1)
            sums = sums + np.where(x.docs[at] == found, x.gain[at], 0)
        hopeful = sums >= least
        if hopeful.any():
            docs, score = _best(np.append(docs, found[hopeful]), np.append(score, sums[hopeful]), k)
            if len(score) == k:
                least = max(least, int(score[-1]))
    return docs, score


def _search(documents: int, occurrences: int, k: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        raw: list[tuple[np.ndarray, np.ndarray, int]] = []
        asked: dict[int, list[int]] = {}
        for batch in batches:
            docs, counts = batch.column("docs"), batch.column("counts")
            for row, (term, weight, items) in enumerate(
                zip(*(batch.column(c).to_pylist() for c in ("term", "weight", "items")), strict=True)
            ):
                if term == DOCUMENTS:
                    ids = np.frombuffer(docs[row].as_buffer(), "<i8")
                    sizes = np.frombuffer(counts[row].as_buffer(), "<u8").astype(np.int64)
                    continue
                for item in items:
                    asked.setdefault(item, []).append(len(raw))
                at = np.frombuffer(docs[row].as_buffer(), "<u2").astype(np.int64)
                raw.append((at, np.frombuffer(counts[row].as_buffer(), "<u4").astype(np.int64), weight))
        norm = 10 + 90 * sizes * documents // max(occurrences, 1)
        lists = []
        for at, count, weight in raw:
            gain = weight * ((1_000_000_000 * count) // (1000 * count + 8 * norm[at]))
            lists.append(List(at, gain, int(gain.max(initial=0))))
        named = pa.array(np.append(ids, 0), mask=np.arange(len(ids) + 1) == len(ids))
        for item in sorted(asked):
            docs, score = best_documents([lists[i] for i in asked[item]], len(sizes), k)
            doc_id = named.take(pa.array(np.minimum(docs, len(ids))))
            yield pa.record_batch(
                {"item_id": pa.array(np.full(len(docs), item)), "doc_id": doc_id, "score": pa.array(score)}
            )

    return rows


def item_terms(items: DataFrame) -> DataFrame:
    """The distinct terms of each item: item_id and term. Rows of one id are one item."""
    lowered = F.translate(F.col("text"), CAPITALS, CAPITALS.lower())
    terms = F.regexp_extract_all(lowered, F.lit(TERM_PATTERN), F.lit(0))
    named = items.where("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), F.explode(terms).alias("term"))
    return named.distinct()


def search(index: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The k documents of highest score for each item of items (item_id, text): item_id, rank, doc_id, score.

    index is a staged table of index_documents. With N documents that have a term and L occurrences
    of terms, a term that df documents hold weighs floor(1000 ln((2N + 2) / (2 df + 1))); its tf
    occurrences in a document of n terms gain it weight * (10^9 tf div (1000 tf + 8 m)), with
    m = 10 + 90 n N div L. An item asks for each of its terms once. Only scores above 0 rank,
    from 1, equal ones by ascending doc_id, a null one last. Rows of one item_id are one item with
    the terms of all; rows without an id are left out; an item without terms, or without one that
    a document holds, has no row. Equal rows of documents rank each.

    Items meet segments through the terms that both hold, in blocks of ITEMS, so a task sees one
    segment's lists for one block. No size of either table is assumed: Spark broadcasts the asked terms
    if they are few, and else deals the lists out by term.
    """
    spark = index.sparkSession
    own = index.where(F.col("term") == DOCUMENTS)
    documents, occurrences = own.agg(F.coalesce(F.sum("df"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    with staged(item_terms(items)) as asked:
        block_count = max(-(-asked.select("item_id").distinct().count() // ITEMS), 1)
        held = index.where(F.col("term") != DOCUMENTS).select("term", "df").join(asked.select("term").distinct(), "term")
        ratio = F.lit(2.0 * documents + 2) / (2 * F.sum("df") + 1)
        weights = held.groupBy("term").agg(F.floor(1000 * F.ln(ratio)).alias("weight"))
        weights = stage(weights.where("weight > 0"))
        block = F.pmod(F.xxhash64("item_id"), F.lit(block_count))
        asks = asked.join(weights, "term").groupBy(block.alias("block"), "term").agg(F.collect_set("item_id").alias("items"))
        asks = stage(asks)
    # The lists are cut down to asked terms before they are dealt out to blocks.
    lists = index.join(weights, "term").join(asks, "term")
    all_blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(block_count - 1).cast("long")))
    columns = ["segment", "block", "term", "weight", "items", "docs", "counts"]
    heads = own.withColumns({"block": all_blocks, "weight": F.lit(0).cast("long"), "items": F.lit([]).cast("array<long>")})
    rows = lists.select(columns).unionByName(heads.select(columns))
    found = rows.groupBy("segment", "block").applyInArrow(
        _search(documents, occurrences, k), "item_id long, doc_id long, score long"
    )
    rank = F.row_number().over(W.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    ranked = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """search over an index of docs that is made for it and deleted afterwards."""
    with staged(index_documents(docs)) as index:
        return stage(search(index, items, k))
