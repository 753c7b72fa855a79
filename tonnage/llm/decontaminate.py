"""Documents that repeat passages of a benchmark, by the q-gram lemma.

A window of a benchmark item begins at each of its characters. A passage that differs from a
window of w characters by at most e edits shares at least w - q + 1 - q * e of its q-grams, and
these lie on neighbouring diagonals (place in the document minus place in the item). So first the
places are found where enough q-grams of any item stand together; there, shared q-grams are lined
up by item, overlapping band of diagonals and place in the item; and every window with enough of
them in a band is verified by an alignment inside the band.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonnage.llm.words import blocks, mix

Q = 8
WINDOW = 50
#: Edits allowed as a percentage of a window.
EDIT_PERCENT = 6
#: Items with fewer characters say too little to mark a document; unsearched_items reports them.
LEAST_ITEM = 24
#: A pass over the documents looks for items of about this many characters together.
ITEM_CHARACTERS = 1 << 20
#: Longer texts are searched in overlapping pieces.
PIECE = 1 << 19
TABLE_BITS = 24
#: Windows aligned at once.
ALIGNED = 1 << 12
#: A stretch that repeats so few characters over and over is cut down to this length, where it is longer.
PERIODS = range(1, 9)
STRETCH = 256
#: Places of a text times places of items that are lined up at once; texts with more are halved.
MOST_HITS = 1 << 20
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 5


@lru_cache(maxsize=1)
def _folded() -> np.ndarray:
    """For each code point the one it counts as; the planes beyond the first two hold no cased letters."""
    table = np.arange(1 << 17, dtype=np.uint32)
    for point in range(len(table)):
        # By way of upper case, so that forms which share one, such as the two small sigmas, are equal.
        upper = chr(point).upper()
        lower = (upper if len(upper) == 1 else chr(point)).lower()
        # The capital I with a dot is the only letter of which lower case makes two.
        table[point] = ord(lower[0])
    table[0x09:0x0E] = 0x20
    return table


def code_points(text: str) -> np.ndarray:
    """Code points with letters lower-cased one by one and white space as blanks."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    table = _folded()
    low = points < len(table)
    points[low] = table[points[low]]
    return points


def gram_codes(points: np.ndarray) -> np.ndarray:
    """A 64-bit code of the Q characters from each place on."""
    if len(points) < Q:
        return np.zeros(0, _U)
    with np.errstate(over="ignore"):
        codes, size = points.astype(_U) + _U(1), 1
        while size < Q:
            codes = codes[:-size] * _U(pow(_BASE, size, 1 << 64)) + codes[size:]
            size *= 2
    return mix(codes)


def shortened(points: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    """points without the inside of long stretches of one short period, and where each that is left stood.

    What is cut out is a multiple of the period, and what stays is several times as long as a window
    with its edits, so every passage of a window's length that was there still is, and no other.
    """
    place = None
    for period in PERIODS:
        if len(points) <= STRETCH:
            break
        # Stretches run between two characters that differ from the one a period before.
        other = np.flatnonzero(points[period:] != points[:-period])
        edges = np.concatenate([[-1], other, [len(points) - period]])
        length = np.diff(edges) - 1
        long = np.flatnonzero(length > STRETCH)
        if not len(long):
            continue
        keep = np.ones(len(points), bool)
        for i in long.tolist():
            start = int(edges[i]) + 1 + STRETCH // 2
            keep[start : start + (int(length[i]) - STRETCH) // period * period] = False
        place = np.flatnonzero(keep) if place is None else place[keep]
        points = points[keep]
    return points, place


@dataclass
class Window:
    item: int
    start: int
    length: int
    edits: int


class Windows(Sequence):
    """The windows of all items, numbered on from item to item; made when asked for."""

    def __init__(self, sizes: list[int]):
        size = np.array(sizes, np.int64)
        self.length = np.minimum(size, WINDOW)
        self.edits = self.length * EDIT_PERCENT // 100
        self.grams = self.length - Q + 1
        self.needed = self.grams - Q * self.edits
        self.count = np.where(size < LEAST_ITEM, 0, size - self.length + 1)
        self.first = np.concatenate([[0], np.cumsum(self.count)]).astype(np.int64)

    def __len__(self) -> int:
        return int(self.first[-1])

    def __getitem__(self, number: int) -> Window:
        if not 0 <= number < len(self):
            raise IndexError(number)
        item = int(np.searchsorted(self.first, number, "right")) - 1
        return Window(item, number - int(self.first[item]), int(self.length[item]), int(self.edits[item]))


class Index:
    """The q-grams of some items, and their windows."""

    def __init__(self, items: tuple[tuple[int, str], ...]):
        self.ids = [i for i, _ in items]
        self.points = [code_points(t) for _, t in items]
        self.windows = Windows([len(p) for p in self.points])
        # The items one after the other, to take many windows at once.
        self.text = np.concatenate([np.zeros(0, np.uint32), *self.points])
        self.begin = np.cumsum([0] + [len(p) for p in self.points])
        codes, item, place = [], [], []
        for number, points in enumerate(self.points):
            if not self.windows.count[number]:
                continue
            grams = gram_codes(points)
            codes.append(grams)
            item.append(np.full(len(grams), number))
            place.append(np.arange(len(grams)))
        codes = np.concatenate([np.zeros(0, _U), *codes])
        order = np.argsort(codes, kind="stable")
        self.codes = codes[order]
        self.item = np.concatenate([np.zeros(0, np.int64), *item])[order]
        self.place = np.concatenate([np.zeros(0, np.int64), *place])[order]
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[(self.codes >> _U(64 - TABLE_BITS)).astype(np.int64)] = True
        used = self.windows.count > 0
        self.fewest = int(self.windows.needed[used].min(initial=WINDOW))
        self.most_edits = int(self.windows.edits[used].max(initial=0))

    def of_item(self, item: int) -> range:
        """Numbers of an item's windows."""
        return range(int(self.windows.first[item]), int(self.windows.first[item + 1]))

    def _dense(self, codes: np.ndarray) -> np.ndarray:
        """Places whose gram may be an item's and which stand among enough such places."""
        likely = self.table[(codes >> _U(64 - TABLE_BITS)).astype(np.int64)]
        span = WINDOW - Q + 1 + self.most_edits
        sums = np.concatenate([[0], np.cumsum(likely, dtype=np.int64)])
        start = np.arange(len(codes))
        enough = sums[np.minimum(start + span, len(codes))] - sums[start] >= self.fewest
        edges = np.zeros(len(codes) + span + 1, np.int64)
        begin = np.flatnonzero(enough)
        np.add.at(edges, begin, 1)
        np.add.at(edges, begin + span, -1)
        return np.flatnonzero(likely & (np.cumsum(edges)[: len(codes)] > 0))

    def _shared(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the text whose gram items hold, and the first and the number of its entries in the index."""
        at = self._dense(codes)
        low = np.searchsorted(self.codes, codes[at], "left")
        return at, low, np.searchsorted(self.codes, codes[at], "right") - low

    def find(self, points: np.ndarray) -> list[tuple[int, int, int]]:
        """Rows (window, start, end): windows that the text holds within their edits, and where.

        A window that a text holds often is reported at some of its places, at one at least.
        """
        if not self.windows or len(points) < Q:
            return []
        points, place = shortened(points)
        found = self._find(points)
        if place is None:
            return found
        # Inside a stretch the characters go on as they would have without the cut.
        place = np.append(place, place[-1] + 1)
        return [(n, int(place[a]), int(place[a]) + b - a) for n, a, b in found]

    def _find(self, points: np.ndarray) -> list[tuple[int, int, int]]:
        at, low, many = self._shared(gram_codes(points))
        overlap = WINDOW + 8 * (self.most_edits + 2)
        if many.sum() > MOST_HITS and len(points) > 8 * overlap:
            middle = len(points) // 2
            right = self._find(points[middle - overlap :])
            shift = middle - overlap
            return self._find(points[: middle + overlap]) + [(n, a + shift, b + shift) for n, a, b in right]
        entry = np.repeat(low - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
        at = np.repeat(at, many)
        # Bands of width diagonals that overlap by half: diagonals as near as the edits share one.
        half = self.most_edits + 1
        item, place = np.tile(self.item[entry], 2), np.tile(self.place[entry], 2)
        band = (at - self.place[entry]) // half
        band = np.concatenate([band, band - 1])
        order = np.lexsort((place, band, item))
        item, band, place = item[order], band[order], place[order]
        distinct = np.ones(len(place), bool)
        distinct[1:] = (item[1:] != item[:-1]) | (band[1:] != band[:-1]) | (place[1:] != place[:-1])
        item, band, place = item[distinct], band[distinct], place[distinct]
        # A gram and the needed-th from it on, both inside one window: so is what lies between.
        gram = np.arange(len(place))
        last = gram + self.windows.needed[item] - 1
        gram, last = gram[last < len(place)], last[last < len(place)]
        same = (item[last] == item[gram]) & (band[last] == band[gram])
        same &= place[last] - place[gram] < self.windows.grams[item[gram]]
        gram, last = gram[same], last[same]
        item, band = item[gram], band[gram]
        low = np.maximum(place[last] - self.windows.grams[item] + 1, 0)
        high = np.minimum(place[gram], self.windows.count[item] - 1) + 1
        again = (item[1:] == item[:-1]) & (band[1:] == band[:-1])
        low[1:] = np.where(again, np.maximum(low[1:], high[:-1]), low[1:])
        many = np.maximum(high - low, 0)
        start = np.repeat(low - np.concatenate([[0], np.cumsum(many)[:-1]])[: len(low)], many) + np.arange(many.sum())
        item, band = np.repeat(item, many), np.repeat(band, many)
        found = []
        for length in np.unique(self.windows.length[item]).tolist():
            mine = np.flatnonzero(self.windows.length[item] == length)
            for cut in range(0, len(mine), ALIGNED):
                some = mine[cut : cut + ALIGNED]
                held, begin, end = self._align(points, length, item[some], start[some], band[some] * half, 2 * half)
                number = self.windows.first[item[some]] + start[some]
                found += zip(number[held].tolist(), begin.tolist(), end.tolist(), strict=True)
        return found

    def _align(
        self, points: np.ndarray, length: int, item: np.ndarray, start: np.ndarray, diagonal: np.ndarray, width: int
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which windows have a passage near enough on diagonals [diagonal, diagonal + width), and the nearest.

        All windows have one length. An alignment of few edits that meets the band leaves it by
        as many diagonals at most, so only those are filled in.
        """
        edits = length * EDIT_PERCENT // 100
        lanes = width + 2 * edits
        base = start + diagonal - edits
        wanted = self.text[self.begin[item] + start + np.arange(length)[:, None]]
        at = base + np.arange(length + lanes)[:, None]
        text = points[np.clip(at, 0, len(points) - 1)]
        text[(at < 0) | (at >= len(points))] = np.iinfo(np.uint32).max
        # Per lane the least edits between the window's first characters and a passage that ends
        # there, times far, plus the lane in which that passage begins.
        far = 1 << lanes.bit_length()
        best = np.repeat(np.arange(lanes, dtype=np.int32)[:, None], len(item), axis=1)
        for i in range(length):
            change = best + (text[i : i + lanes] != wanted[i]) * np.int32(far)
            np.minimum(change[:-1], best[1:] + np.int32(far), out=change[:-1])
            # Characters of the text that the window lacks: more than the edits need not be exact.
            for _ in range(edits):
                np.minimum(change[1:], change[:-1] + np.int32(far), out=change[1:])
            best = change
        lane = np.argmin(best, axis=0)
        least = best[lane, np.arange(len(item))]
        held = least // far <= edits
        begin, end = base + least % far, base + length + lane
        return held, np.clip(begin, 0, len(points))[held], np.clip(end, 0, len(points))[held]


def _leaks(index: Index, texts: list[str]) -> list[dict[int, tuple[int, int]]]:
    """For each text the windows it holds, each with a passage [start, end).

    Texts are searched as one, with more characters between them than a passage can bridge;
    long texts in overlapping pieces.
    """
    overlap = WINDOW + 8 * (index.most_edits + 2)
    pieces, owner, shift = [], [], []
    for number, text in enumerate(texts):
        for low in range(0, max(len(text), 1), PIECE):
            start = max(low - overlap, 0)
            pieces.append(text[start : low + PIECE])
            owner.append(number)
            shift.append(start)
    out: list[dict[int, tuple[int, int]]] = [{} for _ in texts]
    gap = "\x00" * (overlap + WINDOW)
    begin = np.cumsum([0] + [len(p) + len(gap) for p in pieces[:-1]])
    for number, start, end in index.find(code_points(gap.join(pieces))):
        # A passage may count characters of the gap as changed ones; its middle lies in the text.
        piece = int(np.searchsorted(begin, (start + end) // 2, "right")) - 1
        start, end = max(start - int(begin[piece]), 0), min(end - int(begin[piece]), len(pieces[piece]))
        out[owner[piece]].setdefault(number, (start + shift[piece], end + shift[piece]))
    return out


def _rows(items: tuple[tuple[int, str], ...]):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(items)
        for batch, _ in blocks(batches, "text", 1 << 20):
            columns: dict[str, list] = {c: [] for c in ("doc", "item_id", "windows", "of_windows", "start", "end")}
            for doc, found in enumerate(_leaks(index, batch.column("text").fill_null("").to_pylist())):
                for item in sorted({index.windows[n].item for n in found}):
                    spans = [found[n] for n in index.of_item(item) if n in found]
                    start, end = min(a for a, _ in spans), max(b for _, b in spans)
                    row = (doc, index.ids[item], len(spans), len(index.of_item(item)), start, end)
                    for column, value in zip(columns.values(), row, strict=True):
                        column.append(value)
            names = batch.column("doc_id").take(pa.array(columns.pop("doc"), pa.int64()))
            yield pa.record_batch({"doc_id": names} | {c: pa.array(v, pa.int64()) for c, v in columns.items()})

    return rows


def _clean(items: tuple[tuple[int, str], ...]):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(items)
        for batch, _ in blocks(batches, "text", 1 << 20):
            found = _leaks(index, batch.column("text").fill_null("").to_pylist())
            yield batch.filter(pa.array([not x for x in found], pa.bool_()))

    return rows


def item_blocks(benchmark: DataFrame, characters: int = ITEM_CHARACTERS) -> Iterator[tuple[tuple[int, str], ...]]:
    """The items in blocks of about that many characters: the queries of one pass over the documents.

    Items without an id or a text are left out, and repeated items count once.
    """
    usable = benchmark.select("item_id", "text").where("item_id is not null and text is not null").distinct()
    total = usable.agg(F.sum(F.length("text"))).first()[0] or 0
    count = -(-total // characters)
    for number in range(count):
        rows = usable.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == number).collect()
        yield tuple(sorted((r.item_id, r.text) for r in rows))


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows doc_id, item_id, windows, of_windows, start, end: which documents hold passages of which items.

    A document holds a passage if it matches any 50 neighbouring characters of the item (the whole
    item, if shorter, from 24 on) with at most 6 edits in 100; letters of any script count as
    lower-case and any white space as a blank. Such a window begins at each character of the item that 49
    others follow; windows of the item's of_windows were found, between the characters start and
    end of the text. Null texts hold nothing; a row without doc_id is
    reported with a null one; repeated rows are reported each. Other columns are ignored. Shorter
    items are in unsearched_items.
    """
    docs = docs.select("doc_id", "text")
    schema = "doc_id long, item_id long, windows long, of_windows long, start long, end long"
    found = docs.sparkSession.createDataFrame([], schema)
    for items in item_blocks(benchmark):
        found = found.unionByName(docs.mapInArrow(_rows(items), schema))
    return found


def unsearched_items(benchmark: DataFrame) -> DataFrame:
    """Rows item_id, characters: the items that find_leaks does not look for, and how long they are.

    These are items of fewer than 24 characters, without a text (characters is null) or without an id.
    Repeated items are reported once; other columns are ignored.
    """
    items = benchmark.select("item_id", F.char_length("text").cast("long").alias("characters"))
    return items.where(f"item_id is null or characters is null or characters < {LEAST_ITEM}").distinct()


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs with all its columns, without the rows that hold a passage of an item (see find_leaks)."""
    for items in item_blocks(benchmark):
        docs = docs.mapInArrow(_clean(items), docs.schema)
    return docs
