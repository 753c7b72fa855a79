from __future__ import annotations

import random
import time
import tracemalloc

import pytest
from samples import corpus, prose

from tonnage.llm import decontaminate as D
from tonnage.llm.decontaminate import code_points, drop_leaks, find_leaks, unsearched_items


def plain(text):
    return "".join(map(chr, code_points(text)))


def distance(window, text):
    """Least edits between window and any passage of text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(window, 1):
        new = [i]
        for j, b in enumerate(text):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[-1] + 1))
        row = new
    return min(row)


def edited(rng, text, edits):
    text = list(text)
    for _ in range(edits):
        at = rng.randrange(len(text))
        text[at : at + rng.randrange(2)] = rng.choice(["#", "", "%%"])
    return "".join(text)


@pytest.fixture
def items():
    return [(i, prose(500 + i, 6 + 9 * i)) for i in range(6)] + [(90, "too short"), (91, "é中" * 20)]


def test_windows_against_brute_force(items):
    rng, index = random.Random(5), D.Index(tuple(items))
    texts = []
    for _ in range(40):
        item = rng.choice(items)[1]
        start = rng.randrange(max(len(item) - 60, 1))
        texts.append(prose(rng.randrange(99), 8) + " " + edited(rng, item[start : start + 90].upper(), rng.randrange(8)) + prose(rng.randrange(99), 5))
    for text, found in zip(texts, D._leaks(index, texts), strict=True):
        for number, window in enumerate(index.windows):
            wanted = "".join(map(chr, index.points[window.item][window.start : window.start + window.length]))
            assert (number in found) == (distance(wanted, plain(text)) <= window.edits)
            if number in found:
                a, b = found[number]
                assert distance(wanted, plain(text)[a:b]) <= window.edits


@pytest.fixture
def benchmark_table(spark, items):
    rows = [(i, t, "x") for i, t in items] + [(None, "null id " * 9, "x"), (95, None, "x"), items[3] + ("y",)]
    return spark.createDataFrame(rows, "item_id long, text string, doc_id string")


def test_whole_tables(documents, benchmark_table, items, monkeypatch):
    leak, long = items[4][1], prose(8, 20) + "\n" + items[5][1].replace(" ", "\n") + " " + prose(9, 20)
    rows = corpus() + [(700, "x" + leak, "a"), (700, "x" + leak, "a"), (None, leak, "b"), (701, long, None), (702, leak[: len(leak) // 2], "a")]
    docs = documents(rows)
    want = {(700, 4), (None, 4), (701, 5), (702, 4)}
    found = find_leaks(docs, benchmark_table).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want and len(found) == 5
    assert all(0 < r.windows <= r.of_windows and 0 <= r.start < r.end for r in found)
    clean = drop_leaks(docs, benchmark_table)
    assert clean.columns == docs.columns and clean.count() == len(corpus())
    # Several passes, and texts cut into pieces, give the same.
    blocks = list(D.item_blocks(benchmark_table, 300))
    assert len(blocks) > 2 and sorted(i for b in blocks for i, _ in b) == sorted(i for i, _ in items)
    monkeypatch.setattr(D, "PIECE", 64)
    index = D.Index(tuple(items))
    assert {index.windows[n].item for n in D._leaks(index, [long])[0]} == {5}


def test_empty_tables(documents, benchmark_table):
    assert find_leaks(documents([]), benchmark_table).collect() == []
    assert find_leaks(documents(corpus()), benchmark_table.where("false")).collect() == []
    assert drop_leaks(documents(corpus()), benchmark_table.where("false")).count() == len(corpus())


def test_passages_at_any_offset(items):
    index, item = D.Index(tuple(items)), items[5][1]
    starts = range(len(item) - 50 + 1)
    # Every passage of 50 characters counts, and belongs to its own text even at the text's edges.
    texts = [t for s in starts for t in ("#" * 9, item[s : s + 50], "%" * 60 + item[s : s + 50] + "%" * 60)]
    found = D._leaks(index, texts)
    assert not any(found[::3])
    for start, alone, inside in zip(starts, found[1::3], found[2::3], strict=True):
        for hits, at in ((alone, 0), (inside, 60)):
            assert (5, start) in {(index.windows[n].item, index.windows[n].start) for n in hits}
            assert hits[index.of_item(5)[start]] == (at, at + 50)


def test_upper_case_beyond_ascii():
    item = "Où l'été s'achève, dès l'aube, à Évora; ñandúes y pingüinos, Ærø, Łódź, λόγος και Ωκεανός, съешь ещё"
    copy = item.upper()
    index = D.Index(((1, item),))
    assert len(copy) == len(item) and sum(a != b and a > "z" for a, b in zip(item, copy, strict=True)) > 20
    whole, mixed = D._leaks(index, [copy, "x" * 70 + copy.swapcase()])
    assert [whole[n] for n in index.of_item(0)] == [(n, n + 50) for n in range(len(item) - 49)]
    assert len(mixed) == len(whole)
    # One code point stays one, also where a language's upper case has two letters.
    assert len(code_points("İıßẞſΣςµ\t𐐀😀")) == 11 and plain("ςσΣ ſsS ıIi ßẞ 𐐀") == "σσσ sss iii ßß 𐐨"


def windows_of(found):
    return {n for n, _, _ in found}


@pytest.mark.parametrize("hits", [50, 2000])
def test_halves_hold_the_same_windows(items, monkeypatch, hits):
    index = D.Index(tuple(items))
    rng = random.Random(hits)
    text = " ".join(rng.choice([t[rng.randrange(20):][:90] for _, t in items] + [prose(rng.randrange(99), 9)]) for _ in range(60))
    points = code_points(text)
    whole = index._find(points)
    monkeypatch.setattr(D, "MOST_HITS", hits)
    parts = index._find(points)
    assert windows_of(parts) == windows_of(whole) and len(windows_of(whole)) > 20
    # At a cut a passage may be reported by its part on one side, as far as the edits allow.
    for number, start, end in set(parts) - set(whole):
        window = index.windows[number]
        wanted = index.points[window.item][window.start : window.start + window.length]
        assert edit_distance(points[start:end].tolist(), wanted.tolist()) <= window.edits


@pytest.mark.parametrize("unit", ["-", "ab "])
def test_long_stretches_are_cut_without_loss(unit):
    run = (unit * 450)[:450]
    items = ((1, "Fill in the form below: " + run[:150] + " and sign it at the end of the page."), (2, "abc " * 30), (3, run[:60]))
    index = D.Index(items)
    text = prose(5, 40) + " form below: " + run + " and sign it at the end of the page. " + prose(6, 30) + run[1:] + "x" + run
    points = code_points(text)
    short, place = D.shortened(points)
    assert len(short) < len(points) - 400 and (points[place] == short).all()
    whole = index._find(points)
    assert windows_of(index.find(points)) == windows_of(whole) and whole
    for number, start, end in index.find(points):
        window = index.windows[number]
        wanted = index.points[window.item][window.start : window.start + window.length]
        assert abs((end - start) - len(wanted)) <= window.edits
        assert edit_distance(points[start:end].tolist(), wanted.tolist()) <= window.edits


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, above = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, above[j] + 1, above[j - 1] + (x != y)))
    return row[-1]


def test_time_and_memory_follow_a_repetitive_text():
    """Half a million characters of one stretch, and a phrase that text and item repeat."""
    index = D.Index(((1, "form: " + "-" * 150 + " sign"), (2, "now and then " * 14)))
    for text, item in (("-" * 500_000, 0), ("now and then " * 600, 1)):
        tracemalloc.start()
        start = time.time()
        found = D._leaks(index, [text])[0]
        assert time.time() - start < 60 and tracemalloc.get_traced_memory()[1] < 500e6
        tracemalloc.stop()
        assert {index.windows[n].item for n in found} == {item}


def test_items_not_searched_are_reported(spark):
    texts = ["a" * 23, "b" * 24, None, "", "ü" * 23, "ü" * 24, "𝄞" * 23]
    table = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)] * 2 + [(None, "c" * 99, 0)], "item_id long, text string, characters int")
    found = {(r.item_id, r.characters) for r in unsearched_items(table).collect()}
    assert found == {(0, 23), (2, None), (3, 0), (4, 23), (6, 23), (None, 99)}
    assert unsearched_items(table).count() == 6 and unsearched_items(table.limit(0)).count() == 0
    searched = {i for i, t in enumerate(texts) if t and len(code_points(t)) >= D.LEAST_ITEM}
    assert searched == set(range(len(texts))) - {i for i, _ in found}
