"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton on folded text.

Folding lower-cases, maps look-alike letters and digits or signs used as letters to plain
letters, and turns everything else into blanks. Lexicon entries are whole words and beginnings
of words whose weights (log-odds of a toxic label) are learned from labelled documents. Longer
words that begin like an entry but are clean, and given phrases, are exceptions. A document's
score is a calibrated function of the weights it collects and of their share of its length,
but at least the certainty of an entry that clean documents all but never hold.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonnage.llm.words import blocks
from tonnage.sources.staging import stage

#: Labelled documents that weights are learned from, at most, of each label.
SAMPLE_DOCUMENTS = 3000
PREDICT = 0.7
#: Beginnings of words that may become entries, by length.
BEGINNINGS = (4, 5, 6, 7, 8)
#: Toxic documents that an entry must occur in, at least and as a share, and its least log-odds.
LEAST_DOCUMENTS = 4
LEAST_SHARE = 0.01
LEAST_WEIGHT = 2.5
#: Share of a beginning's toxic documents from which a longer entry stands for it.
SPECIFIC = 0.9
#: Share of toxic ones among the documents with an entry from which one hit is enough.
CERTAIN = 0.95

# Letters of other scripts that look like Latin ones.
LOOKALIKES = str.maketrans("аеіјорсухѕһԁɡӏαεικνορτυχıɩʟ", "aeijopcyxshdglaeikvoptuxiil")
# Digits and signs written for letters.
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}
# Harmless phrases of words that also serve as insults.
EXCEPTIONS = (
    "clown fish", "class clown", "trash can", "trash bin", "trash bag", "trash collection",
    "pond scum", "soap scum", "scum line", "sore loser", "pathetic fallacy", "idiot proof",
)

_TABLE = bytearray(b" " * 256)
for _c in range(128, 256):
    _TABLE[_c] = _c
for _c in range(ord("a"), ord("z") + 1):
    _TABLE[_c] = _c
for _a, _b in SIGNS.items():
    _TABLE[ord(_a)] = ord(_b)
_TABLE = bytes(_TABLE)
_WIDE = re.compile("[ıɐ-￿]")


def fold(text: str) -> str:
    """Folded text: blanks around words of letters, one blank before the first and after the last."""
    text = text.lower()
    if _WIDE.search(text):
        # Full-width forms lie at a fixed distance from ASCII.
        text = re.sub("[！-～]", lambda m: chr(ord(m[0]) - 0xFEE0), text).lower().translate(LOOKALIKES)
    return f" {text.encode('utf-8', 'replace').translate(_TABLE).decode('utf-8')} "


def entries_of(folded: str) -> set[str]:
    """Candidate entries of a folded text: its words between blanks and their beginnings after one."""
    words = set(folded.split())
    found = {f" {w} " for w in words if len(w) > 1}
    for size in BEGINNINGS:
        found.update(" " + w[:size] for w in words if len(w) > size)
    return found


@dataclass
class Lexicon:
    """Entries with weights, exceptions of weight 0, and the line from a text's features to log-odds.

    certain has the share of toxic documents among those with an entry, where it is high.
    """

    weights: dict[str, float]
    line: tuple[float, ...] = (-2.0, 0.0, 0.0)
    certain: dict[str, float] = field(default_factory=dict)
    _automaton: object = field(default=None, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"_automaton": None}

    def automaton(self):
        if self._automaton is None:
            import ahocorasick

            self._automaton = ahocorasick.Automaton()
            for entry, weight in self.weights.items():
                self._automaton.add_word(entry, (len(entry), weight, self.certain.get(entry, 0.0)))
            if self.weights:
                self._automaton.make_automaton()
        return self._automaton

    def hits(self, folded: str) -> list[tuple[float, float]]:
        """Weight and certainty of the longest entry at each place; an exception phrase covers its words."""
        if not self.weights:
            return []
        longest: dict[int, tuple[int, float, float]] = {}
        for end, entry in self.automaton().iter(folded):
            start = end - entry[0] + 1
            if start not in longest or entry[0] > longest[start][0]:
                longest[start] = entry
        found, covered = [], -1
        for start in sorted(longest):
            length, weight, certain = longest[start]
            if weight == 0.0:
                covered = max(covered, start + length - 1)
            elif start >= covered:
                found.append((weight, certain))
        return found

    def features(self, text: str) -> tuple[float, float, float]:
        """Collected weight, its share of the text's length in words, both on a log scale; the best certainty."""
        folded = fold(text)
        hits = self.hits(folded)
        total = sum(w for w, _ in hits)
        share = 100 * total / (folded.count(" ") + 1)
        return float(np.log1p(total)), float(np.log1p(share)), max((c for _, c in hits), default=0.0)

    def score(self, text: str) -> float:
        total, share, certain = self.features(text)
        odds = np.clip(np.dot(self.line, (1.0, total, share)), -30, 30)
        return max(float(1 / (1 + np.exp(-odds))), certain)


def training_rows(labels: DataFrame) -> DataFrame:
    """Labels that may be learned from: those whose crc32(doc_id as text) mod 3 is not 1."""
    usable = labels.where("toxic in (0, 1) and doc_id is not null").where(~held_out())
    return usable.select("doc_id", "toxic").distinct()


def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: tuple[Counter, Counter] = (Counter(), Counter())

    def flush() -> pa.RecordBatch:
        names = list(counts[0].keys() | counts[1].keys())
        batch = {
            "entry": pa.array(names, pa.string()),
            "clean": pa.array([counts[0][x] for x in names], pa.int64()),
            "toxic": pa.array([counts[1][x] for x in names], pa.int64()),
        }
        for c in counts:
            c.clear()
        return pa.record_batch(batch)

    for batch, _ in blocks(batches, "text"):
        texts = batch.column("text").fill_null("").to_pylist()
        for text, toxic in zip(texts, batch.column("toxic").to_pylist(), strict=True):
            counts[int(toxic)].update(entries_of(fold(text)))
        if len(counts[0]) + len(counts[1]) > 200_000:
            yield flush()
    yield flush()


def _kept_entries(rows: list, clean: int, toxic: int) -> dict[str, float]:
    """Entries that say more than their own beginnings do, and clean words that begin like one.

    A beginning whose toxic documents nearly all hold one longer entry gives way to that.
    """
    toxic_in = {r.entry: r.toxic for r in rows}
    too_short = {
        x for r in rows for n in range(2, len(r.entry))
        if (x := r.entry[:n]) in toxic_in and r.toxic >= SPECIFIC * toxic_in[x]
    }
    weight = {
        r.entry: float(np.log((r.toxic + 0.5) / (toxic + 1)) - np.log((r.clean + 0.5) / (clean + 1))) for r in rows
    }
    kept: dict[str, float] = {}
    for entry in sorted(weight, key=lambda x: (len(x.strip()), not x.endswith(" "), x)):
        beginnings = [x for n in range(2, len(entry)) if (x := entry[:n]) in kept]
        if entry in too_short:
            continue
        if weight[entry] >= LEAST_WEIGHT:
            if not any(kept[x] for x in beginnings):
                kept[entry] = weight[entry]
        elif beginnings and weight[entry] < LEAST_WEIGHT / 2:
            kept[entry] = 0.0
    return kept


def learn(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_DOCUMENTS) -> Lexicon:
    """A lexicon from at most most labelled documents of each label, those whose doc_id hashes lowest.

    The line of the score is fitted on the same documents, weighted to the share of toxic labels
    among all rows that may be learned from. All entries that qualify are kept: one is in at least
    LEAST_SHARE of the toxic sample, so there are at most 1 / LEAST_SHARE times as many as a toxic
    document has on average. With labels of one kind only, the lexicon is empty
    and every score is that share, which is 0 without labels.
    """
    usable = training_rows(labels)
    size = {r.toxic: r["count"] for r in usable.groupBy("toxic").count().collect()}
    sizes = (size.get(0, 0), size.get(1, 0))
    share = min(max(sizes[1] / max(sum(sizes), 1), 1e-3), 1 - 1e-3)
    constant = (float(np.log(share / (1 - share))), 0.0, 0.0)
    if not all(sizes):
        return Lexicon({}, constant)
    order = F.xxhash64("doc_id")
    sample, toxic_sample = (usable.where(f"toxic = {x}").orderBy(order).limit(most) for x in (0, 1))
    sample = sample.unionByName(toxic_sample)
    texts = stage(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id"))
    clean, toxic = (texts.where(f"toxic = {x}").count() for x in (0, 1))
    counts = texts.mapInArrow(_candidates, "entry string, clean long, toxic long").groupBy("entry")
    counts = counts.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    counts = stage(counts.where(f"toxic >= {LEAST_DOCUMENTS} or clean >= {LEAST_DOCUMENTS}"))
    ratio = (F.col("toxic") + 0.5) / (toxic + 1) / ((F.col("clean") + 0.5) / (clean + 1))
    enough = max(LEAST_DOCUMENTS, LEAST_SHARE * toxic)
    strong = counts.where((F.col("toxic") >= enough) & (ratio >= float(np.exp(LEAST_WEIGHT))))
    strong = stage(strong)
    # Clean words and beginnings that start like a strong entry: its exceptions.
    starts = strong.select("entry").where("entry not like '% '").withColumnRenamed("entry", "start")
    begins = counts.withColumn("start", F.explode(F.array(*[F.substring("entry", 1, n + 1) for n in BEGINNINGS])))
    mild = (F.col("clean") >= LEAST_DOCUMENTS) & (ratio < float(np.exp(LEAST_WEIGHT / 2)))
    softer = begins.where(mild & (F.col("entry") != F.col("start"))).join(F.broadcast(starts), "start")
    softer = softer.select(*counts.columns).distinct()
    rows = strong.collect()
    kept = _kept_entries(rows + softer.collect(), clean, toxic)
    kept |= {f" {x} ": 0.0 for x in EXCEPTIONS}
    # Counts of the sample, brought to the sizes of all labels.
    ups = sizes[0] / clean, sizes[1] / toxic
    certain = {r.entry: ups[1] * r.toxic / (ups[1] * r.toxic + ups[0] * (r.clean + 0.5) + 1) for r in rows}
    lexicon = Lexicon(kept, certain={x: share for x, share in certain.items() if x in kept and share >= CERTAIN})
    rows = sorted(tuple(r) for r in texts.mapInArrow(_features(lexicon), "toxic int, a double, b double").collect())
    x, y = np.array([r[1:] for r in rows]), np.array([r[0] for r in rows], float)
    importance = np.where(y == 1, share / max(y.sum(), 1), (1 - share) / max((1 - y).sum(), 1)) * len(y)
    lexicon.line = _fit(np.column_stack([np.ones(len(y)), x]), y, importance)
    return lexicon


def _fit(x: np.ndarray, y: np.ndarray, importance: np.ndarray) -> tuple[float, ...]:
    theta = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        bend = (x * (importance * (p * (1 - p) + 1e-9))[:, None]).T @ x + 0.1 * np.eye(len(theta))
        theta = theta + np.linalg.solve(bend, x.T @ (importance * (y - p)) - 0.1 * theta)
    return tuple(map(float, theta))


def _features(lexicon: Lexicon):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _ in blocks(batches, "text"):
            found = [lexicon.features(t) for t in batch.column("text").fill_null("").to_pylist()]
            columns = {c: pa.array([x[i] for x in found], pa.float64()) for i, c in enumerate("ab")}
            yield pa.record_batch({"toxic": batch.column("toxic").cast(pa.int32())} | columns)

    return rows


def _scores(lexicon: Lexicon):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _ in blocks(batches, "text"):
            texts = batch.column("text").fill_null("").to_pylist()
            scores = pa.array(list(map(lexicon.score, texts)), pa.float64())
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "score": scores})

    return rows


def score_toxicity(docs: DataFrame, lexicon: Lexicon, threshold: float = PREDICT) -> DataFrame:
    """doc_id, held_out, score and predicted for each row of docs.

    A null text is scored as an empty one; a null doc_id is not held out. Every row is scored by
    itself, so repeated rows get equal scores. Other columns are ignored.
    """
    scored = docs.select("doc_id", "text").mapInArrow(_scores(lexicon), "doc_id long, score double")
    predicted = (F.col("score") >= threshold).cast("int").alias("predicted")
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", predicted)
