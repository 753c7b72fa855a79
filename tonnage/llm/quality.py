"""Document quality: counted base rules, then a calibrated n-gram classifier.

The classifier is a logistic regression on shares of hashed word and character n-grams. It is
fitted on a bounded sample of labelled documents, its score is made a probability on documents
held back from the fit, and documents are scored in Arrow batches against a fixed threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonnage.llm.words import (
    Texts,
    Words,
    blocks,
    find_words,
    give_back_memory,
    hash_ranges,
    mix,
    texts_of,
    whole_windows,
    window_hashes,
    words_of,
)
from tonnage.sources.staging import staged

#: Labelled documents used for fitting and calibration, at most.
SAMPLE_DOCUMENTS = 3000
#: Probability of good quality from which a document is kept.
KEEP = 0.5
MIN_WORDS = 50
MOST_REPEATED_PERCENT = 50

WORD_SIZES = (1, 2)
CHARACTER_SIZES = (3, 4)
#: The buckets of all families together are numbered by 16 bits.
BITS = 14
#: Character n-grams are hashed for so many places at a time.
SLAB = 1 << 18
#: The fit goes over its rows in parts of about this many features.
FIT_FEATURES = 1 << 20
SYMBOLS = np.zeros(256, bool)
SYMBOLS[np.frombuffer(b"#*$%&|<>", np.uint8)] = True
NOT_NEWLINE = np.arange(256) != 10
_U = np.uint64


def _sums(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sum of values between each two neighbouring edges."""
    sums = np.concatenate([np.zeros(1, values.dtype if values.dtype.kind == "f" else np.int64), np.cumsum(values)])
    return np.diff(sums[edges])


def duplicate_lines(texts: Texts, words: Words) -> np.ndarray:
    """Per text the lines with a word that equal an earlier line of the text."""
    start, end, first = find_words(texts, NOT_NEWLINE)
    at = np.searchsorted(words.start, start)
    has_word = np.append(words.start, len(texts.data) + 1)[at] < end
    start, end = start[has_word], end[has_word]
    text = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(np.flatnonzero(has_word), first)))
    lines = pd.DataFrame({"text": text, "line": hash_ranges(texts.data, start, end)})
    return np.bincount(text[lines.duplicated().to_numpy()], minlength=len(texts))


def repeated_words(words: Words, size: int = 3) -> np.ndarray:
    """Per text the words in windows of size words that the text holds twice or more."""
    at = whole_windows(words.first, size)
    text = words.text()
    windows = pd.DataFrame({"text": text[at], "window": window_hashes(words.hash, size, 21)[at]})
    again = at[windows.duplicated(keep=False).to_numpy()]
    marked = np.zeros(len(words.start) + size, bool)
    for i in range(size):
        marked[again + i] = True
    return _sums(marked[: len(words.start)], words.first)


def base_counts(texts: Texts) -> dict[str, np.ndarray]:
    """The counts of the base rules for each text."""
    words = words_of(texts)
    inside = np.zeros(len(texts.data) + 1, np.int8)
    inside[words.start] = 1
    np.subtract.at(inside, words.end, 1)
    inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    inside &= (texts.data & 0xC0) != 0x80
    return {
        "n_words": np.diff(words.first),
        "word_chars": _sums(inside, texts.offsets),
        "n_symbols": _sums(SYMBOLS[texts.data], texts.offsets),
        "n_dup_lines": duplicate_lines(texts, words),
        "n_repeat_words": repeated_words(words),
    }


def _character_buckets(data: np.ndarray, size: int, number: int) -> np.ndarray:
    """The bucket of the size bytes from each place on, worked out a slab at a time."""
    out = np.empty(max(len(data) - size + 1, 0), np.int32)
    for low in range(0, len(out), SLAB):
        high = min(low + SLAB, len(out))
        code = np.zeros(high - low, np.uint32)
        for i in range(size):
            code = (code << np.uint32(8)) | data[low + i : high + i]
        out[low:high] = (mix(code.astype(_U) + _U(size)) >> _U(64 - BITS)).astype(np.int32) + (number << BITS)
    return out


def _grams(texts: Texts) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Family by family the bucket of the gram at each place, and from where to where each text's grams begin.

    Character n-grams run over UTF-8 bytes, so a letter beyond ASCII counts as two or more.
    Only one family is held at a time. Grams that span two texts lie outside all ranges.
    """
    words = words_of(texts)
    for number, size in enumerate(WORD_SIZES):
        bucket = (window_hashes(words.hash, size, 31) >> _U(64 - BITS)).astype(np.int32) + (number << BITS)
        yield bucket, words.first[:-1], np.maximum(words.first[1:] - size + 1, words.first[:-1])
    del words, bucket
    for number, size in enumerate(CHARACTER_SIZES, len(WORD_SIZES)):
        bucket = _character_buckets(texts.data, size, number)
        yield bucket, texts.offsets[:-1], np.maximum(texts.offsets[1:] - size + 1, texts.offsets[:-1])


def features(texts: Texts) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text the buckets it fills and the share each has among the grams of its family."""
    parts: list[list] = [[] for _ in range(len(texts))]
    for bucket, begin, end in _grams(texts):
        for i, part in enumerate(parts):
            found, count = np.unique(bucket[begin[i] : end[i]], return_counts=True)
            part.append((found, count / max(count.sum(), 1)))
    return [(np.concatenate([a for a, _ in p]), np.concatenate([b for _, b in p])) for p in parts]


@dataclass
class Model:
    """Weights by bucket, and the line that turns a raw score into log-odds of good quality."""

    weights: np.ndarray
    slope: float
    intercept: float

    def probability(self, texts: Texts) -> np.ndarray:
        raw = np.zeros(len(texts))
        for bucket, begin, end in _grams(texts):
            some = np.flatnonzero(end > begin)
            if len(some):
                # Every second sum is that of a range; the last place only ends one.
                places = np.stack([begin[some], end[some]], 1).ravel()
                sums = np.add.reduceat(np.append(self.weights[bucket], 0.0), places)[::2]
                raw[some] += sums / (end - begin)[some]
        return 1 / (1 + np.exp(-np.clip(self.slope * raw + self.intercept, -30, 30)))


def _fit_line(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Log-odds of y as a line in x, by Newton steps with a little shrinkage."""
    design, theta = np.stack([x, np.ones(len(x))], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
        slope = design.T @ (y - p) - 1e-3 * theta
        theta = theta + np.linalg.solve((design * (p * (1 - p) + 1e-9)[:, None]).T @ design + 1e-3 * np.eye(2), slope)
    return float(theta[0]), float(theta[1])


def fit(rows: list[tuple[np.ndarray, np.ndarray]], good: np.ndarray, rounds: int = 60, step: float = 0.3) -> Model:
    """Fit weights on four of five rows by Adam, and the probability line on the fifth.

    Without rows of both kinds every document gets the share of good rows, or 1 without rows.
    """
    size = (len(WORD_SIZES) + len(CHARACTER_SIZES)) << BITS
    kinds = np.unique(good)
    if len(kinds) < 2:
        share = np.clip(kinds[0] if len(kinds) else 1.0, 0.01, 0.99)
        return Model(np.zeros(size), 0.0, float(np.log(share / (1 - share))))
    # A seeded shuffle within each kind, so that both parts hold both kinds.
    order = np.random.Generator(np.random.PCG64(5)).permutation(len(good))
    held = np.zeros(len(good), bool)
    for kind in kinds:
        held[order[good[order] == kind][::5]] = True
    lengths = np.array([len(a) for a, _ in rows])
    ends = np.cumsum(lengths)
    column = np.concatenate([a for a, _ in rows])
    value = np.concatenate([b for _, b in rows]).astype(np.float32, copy=False)
    edges = np.concatenate([[0], ends])
    cuts = np.unique(np.append(np.searchsorted(edges, np.arange(0, edges[-1], FIT_FEATURES)), [0, len(rows)]))
    parts = [(a, b, slice(edges[a], edges[b])) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]

    def raw(w: np.ndarray) -> np.ndarray:
        return np.concatenate([_sums(w[column[s]] * value[s], edges[a : b + 1] - edges[a]) for a, b, s in parts])

    def gradient(error: np.ndarray) -> np.ndarray:
        sums = np.zeros(size)
        for a, b, s in parts:
            sums += np.bincount(column[s], np.repeat(error[a:b], lengths[a:b]) * value[s], size)
        return sums

    used = ~held
    shares = 0.5 / max((1 - good[used]).sum(), 1), 0.5 / max(good[used].sum(), 1)
    balance = np.where(good == 1, shares[1], shares[0]) * used
    weights, bias = np.zeros(size), 0.0
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(raw(weights) + bias, -30, 30)))
        error = (p - good) * balance
        slope = np.append(gradient(error) + 1e-7 * weights, error.sum())
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        move = step * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    return Model(weights, *_fit_line(raw(weights)[held], good[held].astype(float)))


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in blocks(batches, "text"):
        found = features(texts)
        yield pa.record_batch(
            {
                "doc_id": batch.column("doc_id"),
                "quality": batch.column("quality").cast(pa.int32()),
                "buckets": pa.array([a.astype("<u2").tobytes() for a, _ in found], pa.binary()),
                "shares": pa.array([b.astype("<f4").tobytes() for _, b in found], pa.binary()),
            }
        )


def train(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_DOCUMENTS) -> Model:
    """Fit a model on at most most labelled documents, those whose doc_id hashes lowest.

    Their features, some 15 kB a document, are what the driver holds for the fit; they come
    file by file. Labels other than 0 and 1 and labels without a document are left out.
    """
    usable = labels.select("doc_id", "quality").where("quality in (0, 1) and doc_id is not null").distinct()
    sample = usable.orderBy(F.xxhash64("doc_id"), "quality").limit(most)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    with staged(rows.mapInArrow(_sampled, "doc_id long, quality int, buckets binary, shares binary")) as features_:
        found = sorted(tuple(map(_plain, r)) for r in features_.toLocalIterator())
    good = np.array([r[1] for r in found], np.int64)
    model = fit([(np.frombuffer(r[2], "<u2"), np.frombuffer(r[3], "<f4")) for r in found], good)
    del found
    give_back_memory()
    return model


def _plain(value):
    return bytes(value) if isinstance(value, bytearray) else value


def _judge(model: Model, least: float):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches, "text"):
            counts = base_counts(texts)
            words = counts["n_words"]
            failed = (words < MIN_WORDS) | (100 * counts["n_repeat_words"] > MOST_REPEATED_PERCENT * words)
            good = model.probability(texts)
            columns = {k: pa.array(v.astype(np.int64)) for k, v in counts.items()}
            columns |= {"base_failed": pa.array(failed), "quality": pa.array(good)}
            columns["kept"] = pa.array(~failed & (good >= least))
            names = batch.schema.names
            yield pa.record_batch({c: batch.column(c) for c in names} | columns)

    return rows


ADDED = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, quality double, kept boolean"
)


def judge_quality(docs: DataFrame, model: Model, least: float = KEEP) -> DataFrame:
    """doc_id and text with the base counts, base_failed, quality (a probability) and kept.

    Words are longest runs of non-blank characters, lines are cut at newlines. A document fails
    the base rules with fewer than 50 words, or if more than half of its words lie in 3-word
    windows that it holds twice or more; of the others those of probability least or more are
    kept. A null text counts as empty, has no words and fails. Rows are judged one by one, so
    repeated rows and null ids change nothing. Other columns are ignored.
    """
    return docs.select("doc_id", "text").mapInArrow(_judge(model, least), f"doc_id long, text string, {ADDED}")


def _good(model: Model, least: float):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches, "text"):
            words = np.diff(find_words(texts)[2])
            keep = words >= MIN_WORDS
            at = np.flatnonzero(keep)
            part = texts_of(batch.column("text").take(pa.array(at)))
            repeated = repeated_words(words_of(part))
            keep[at] = (100 * repeated <= MOST_REPEATED_PERCENT * words[at]) & (model.probability(part) >= least)
            yield batch.filter(pa.array(keep))

    return rows


def keep_good(docs: DataFrame, model: Model, least: float = KEEP) -> DataFrame:
    """The rows of docs, with all columns, that judge_quality keeps."""
    return docs.mapInArrow(_good(model, least), docs.schema)
