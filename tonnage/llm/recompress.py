"""Recompression of word sequences: rounds that name runs and pairs the same way everywhere.

A round first names every longest run of one symbol by (symbol, length), then splits all
symbols into left and right ones by a hash and names each neighbouring (left, right) pair.
Names are hashes of what they stand for, so all tasks give equal sequences equal names
without talking to each other.

Whether a symbol forms depends on its neighbours. Each symbol therefore carries the range
of words that decided it. A symbol whose range lies inside a window is an interior symbol
of that window: it forms in every text that holds the window, at the same place.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from tonnage.llm.words import mix, window_hashes

_U = np.uint64
FAR = 1 << 30
#: Words of a key as a percentage of a window: more tell windows apart better but make more keys.
KEY_PART = 40


@dataclass
class Level:
    """Symbols of a block of texts: name, words [start, end), text, deciding words [low, high).

    Deciding words are left out where only the symbols' own words matter.
    """

    name: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    low: np.ndarray | None = None
    high: np.ndarray | None = None

    def take(self, at: np.ndarray) -> Level:
        columns = (getattr(self, c) for c in self.__dataclass_fields__)
        return Level(*(None if c is None else c[at] for c in columns))

    def bare(self) -> Level:
        return Level(self.name, self.start, self.end, self.text)


def words_level(hashes: np.ndarray, text: np.ndarray) -> Level:
    """Round 0: every word is its own symbol."""
    at = np.arange(len(hashes), dtype=np.int32)
    return Level(mix(hashes + _U(77)), at, at + 1, text.astype(np.int32), at, at + 1)


def _neighbour_ranges(level: Level) -> tuple[np.ndarray, ...]:
    """Deciding ranges of the left and right neighbours; the edge of a text decides without limit."""
    same = level.text[1:] == level.text[:-1]
    left_low, left_high, right_low, right_high = (np.full(len(same) + 1, x, np.int32) for x in (-FAR, FAR, -FAR, FAR))
    left_low[1:] = np.where(same, level.low[:-1], -FAR)
    left_high[1:] = np.where(same, level.high[:-1], FAR)
    right_low[:-1] = np.where(same, level.low[1:], -FAR)
    right_high[:-1] = np.where(same, level.high[1:], FAR)
    return left_low, left_high, right_low, right_high


def name_runs(level: Level, number: int) -> Level:
    """Replace each longest run of two or more equal symbols by one symbol."""
    if not len(level.name):
        return level
    new = np.ones(len(level.name), bool)
    new[1:] = (level.name[1:] != level.name[:-1]) | (level.text[1:] != level.text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(new)) - 1
    count = (last - first + 1).astype(_U)
    with np.errstate(over="ignore"):
        run = mix(level.name[first] + mix(count + _U(1000 + number)))
    out = Level(np.where(count > 1, run, level.name[first]), level.start[first], level.end[last], level.text[first])
    if level.low is None:
        return out
    left_low, left_high, right_low, right_high = _neighbour_ranges(level)
    out.low = np.minimum.reduce([left_low[first], level.low[first], level.low[last], right_low[last]])
    out.high = np.maximum.reduce([left_high[first], level.high[first], level.high[last], right_high[last]])
    return out


def name_pairs(level: Level, number: int) -> Level:
    """Replace each neighbouring (left, right) pair by one symbol."""
    if not len(level.name):
        return level
    left = (mix(level.name + _U(2000 + number)) >> _U(63)).astype(bool)
    opens = np.zeros(len(left), bool)
    opens[:-1] = left[:-1] & ~left[1:] & (level.text[1:] == level.text[:-1])
    closes = np.zeros(len(left), bool)
    closes[1:] = opens[:-1]
    keep = np.flatnonzero(~closes)
    pair = opens[keep]
    mate = keep + pair
    name = level.name[keep]
    with np.errstate(over="ignore"):
        name[pair] = mix(mix(name[pair] + _U(3000 + number)) * _U(3) + level.name[mate[pair]])
    out = Level(name, level.start[keep], level.end[mate], level.text[keep])
    if level.low is None:
        return out
    # A left symbol stays alone because of what follows it, a right one because of what precedes it.
    left_low, left_high, right_low, right_high = _neighbour_ranges(level)
    low = np.minimum(level.low, np.where(left, right_low, left_low))
    high = np.maximum(level.high, np.where(left, right_high, left_high))
    out.low = np.where(pair, np.minimum(level.low[keep], level.low[mate]), low[keep])
    out.high = np.where(pair, np.maximum(level.high[keep], level.high[mate]), high[keep])
    return out


def next_level(level: Level, number: int) -> Level:
    """One round: runs, then pairs."""
    return name_pairs(name_runs(level, number), number)


def anchors(levels: list[Level], size: int, width: int, count: int) -> np.ndarray:
    """For each window of size words the place of its most telling interior symbol.

    Only symbols that start at least width words before the window's end count. Symbols of
    later rounds win, then the larger name, then the first place, so the choice depends on the
    words of the window alone. A window without such a symbol takes one of its words.
    """
    best = np.zeros(max(count - size + 1, 0), _U)
    place = np.full(len(best), FAR, np.int32)
    reach = []
    for number, level in enumerate(levels[1:], 1):
        level = level.take(np.flatnonzero((level.high - level.low <= size) & (level.end - level.start > 1)))
        value = (level.name >> _U(4)) | _U(number << 60)
        # The windows [low - room, low] see the symbol.
        room = np.minimum(size - (level.high - level.low), size - width - (level.start - level.low))
        reach.append((value, level.low, level.start, room))
    for value, low, _, room in reach:
        for back in range(size):
            at = low - back
            ok = np.flatnonzero((room >= back) & (at >= 0) & (at < len(best)))
            np.maximum.at(best, at[ok], value[ok])
    for value, low, start, room in reach:
        for back in range(size):
            at = low - back
            ok = np.flatnonzero((room >= back) & (at >= 0) & (at < len(best)))
            ok = ok[best[at[ok]] == value[ok]]
            np.minimum.at(place, at[ok], start[ok])
    alone = np.flatnonzero(best == 0)
    words = levels[0].name >> _U(4)
    for i in range(size - width + 1):
        here = words[alone + i]
        better = here > best[alone]
        place[alone[better]] = alone[better] + i
        best[alone] = np.maximum(best[alone], here)
    return place


def window_keys(hashes: np.ndarray, levels: list[Level], size: int) -> np.ndarray:
    """A 48-bit key for each window of size words: some words from its anchor on.

    Neighbouring windows mostly share an anchor and with it a key, so a text has far fewer
    keys than windows, and equal windows always have equal keys.
    """
    width = max(size * KEY_PART // 100, 1)
    place = anchors(levels, size, width, len(hashes))
    return window_hashes(hashes, width, 5)[place] >> _U(16)


def repeat_symbols(
    level: Level, rounds: range, report: tuple[int, ...], size: int
) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Go on for some rounds; the symbols of at least size words after each round of report.

    Such a symbol stands for its words alone, so two texts that hold it share all of them.
    """
    out = []
    level = level.bare()
    for number in rounds:
        level = next_level(level, number)
        if number in report:
            long = np.flatnonzero(level.end - level.start >= size)
            out.append((level.name[long], level.start[long], level.end[long]))
    return out
