"""Near-duplicate documents by HyperMinHash sketches, banding and a check on full sets.

A sketch has 256 registers. A shingle's hash picks a register, which keeps the smallest rest
of the hashes it sees as a float: the count of leading zeros and ten mantissa bits. Four
registers make a band. Two documents with Jaccard similarity 0.75 share a band of 64 with a
probability of 1 - 3e-11. Sets of few shingles leave registers empty; for banding these copy
others, in an order that is the same for all sets.

Documents with equal shingle sets become one node. In every band each node is paired with
the band's least node, and of its pairs the most promising is checked. Links make components.
Nodes that share a band with a node of another component are then joined exactly, class by class
of equal shared shingles, by the rarest of these (see _between_components), so a link that could join two
components is never left out. Only pairs inside a component go unseen.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonnage.llm.components import components
from tonnage.llm.words import LOWER, Texts, blocks, sequence_hashes, whole_windows, window_hashes, words_of
from tonnage.sources.staging import stage, staged, staged_alone

SHINGLE = 5
PERCENT = 75
REGISTERS = 256
ROWS = 4
MANTISSA = 10
#: Pairs whose estimate lies this many standard deviations below the threshold are not checked.
SLACK = 6.5


def shingle_sets(texts: Texts, size: int) -> list[np.ndarray]:
    """The sorted set of hashed shingles of each text; a shorter text is one shingle."""
    words = words_of(texts, fold=LOWER)
    hashes = window_hashes(words.hash, size, 11)
    at = whole_windows(words.first, size)
    hashes, edge = hashes[at], np.searchsorted(at, words.first)
    short = sequence_hashes(words.hash, words.first[:-1], words.first[1:], 12)
    count = np.diff(words.first)
    return [
        np.unique(hashes[edge[i] : edge[i + 1]]) if count[i] >= size else short[i : i + min(count[i], 1)]
        for i in range(len(texts))
    ]


def sketches_of(sets: list[np.ndarray]) -> np.ndarray:
    """Registers of sorted sets of hashes, a row for each set; 0 is an empty register."""
    out = np.zeros((len(sets), REGISTERS), np.uint16)
    bounds = np.arange(REGISTERS, dtype=np.uint64) << np.uint64(56)
    for row, shingles in zip(out, sets, strict=True):
        at = np.searchsorted(shingles, bounds)
        used = np.flatnonzero(np.diff(np.append(at, len(shingles))))
        rest = (shingles[at[used]] << np.uint64(8)) >> np.uint64(12)
        fraction, bits = np.frexp(rest.astype(np.float64))
        mantissa = np.floor((2 * fraction - 1).clip(0) * (1 << MANTISSA)).astype(np.int64)
        row[used] = 1 + ((52 - bits.astype(np.int64)) << MANTISSA) + mantissa
    return out


_PROBES = np.random.Generator(np.random.PCG64(17)).integers(0, REGISTERS, (4096, REGISTERS), dtype=np.uint8)


def filled(sketches: np.ndarray) -> np.ndarray:
    """Sketches whose empty registers copy the first used one in a probe order of their own.

    The order is the same for all sets, so filled registers agree as often as used ones do,
    and bands of small sets tell as much as those of large ones.
    """
    out = sketches.copy()
    rows = np.flatnonzero((sketches > 0).any(axis=1))
    for probe in _PROBES:
        rows = rows[(out[rows] == 0).any(axis=1)]
        if not len(rows):
            break
        part = out[rows]
        out[rows] = np.where(part == 0, sketches[rows][:, probe], part)
    return out


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _sketches(size: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches, "text"):
            sets = shingle_sets(texts, size)
            sketches = sketches_of(sets)
            full = filled(sketches)
            used = np.packbits(sketches > 0, axis=1)
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_shingles": pa.array([len(x) for x in sets], pa.int64()),
                    "digest": pa.array([_digest(x) for x in sets], pa.binary()),
                    "sketch": pa.array(
                        [a.tobytes() + b.tobytes() for a, b in zip(full, used, strict=True)], pa.binary()
                    ),
                }
            )

    return rows


def _sets(size: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches, "text"):
            sets = shingle_sets(texts, size)
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int32)
            values = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
            yield pa.record_batch(
                {"node": batch.column("doc_id"), "shingles": pa.ListArray.from_arrays(offsets, pa.array(values))}
            )

    return rows


def expected_collisions(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Chance that the registers of two unrelated sets of n and m shingles are equal."""
    level = np.arange(53)

    def share(count: np.ndarray) -> np.ndarray:
        per = (count / REGISTERS)[:, None]
        return (1 - 2.0 ** -(level + 1)) ** per - (1 - 2.0**-level) ** per

    return (share(n) * share(m)).sum(axis=1) / (1 << MANTISSA)


def estimates(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimates of pairs of sketches, corrected for collisions, and the registers in use."""
    used = ((a > 0) | (b > 0)).sum(axis=1)
    equal = ((a == b) & (a > 0)).sum(axis=1)
    chance = expected_collisions(n, m)
    return (equal / np.maximum(used, 1) - chance) / (1 - chance), used


def _own_registers(column: pa.Array) -> np.ndarray:
    """The registers of stored sketches, without the filled ones."""
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)
    registers = np.ascontiguousarray(raw[:, : 2 * REGISTERS]).view(np.uint16)
    return registers * np.unpackbits(raw[:, 2 * REGISTERS :], axis=1)


def _promising(percent: int):
    """Pairs that may reach the threshold, by size and by estimate."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n, m = (np.asarray(batch.column(c), np.float64) for c in ("n_a", "n_b"))
            a, b = (_own_registers(batch.column(c)) for c in ("sketch_a", "sketch_b"))
            estimate, used = estimates(a, b, n, m)
            least = percent / 100
            keep = estimate >= least - SLACK * np.sqrt(least * (1 - least) / np.maximum(used, 1))
            keep &= 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
            batch = batch.filter(pa.array(keep))
            yield pa.record_batch({"a": batch.column("a"), "b": batch.column("b")})

    return rows


def _likely(nodes: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes that may reach the threshold by their sketches."""
    for side in "ab":
        own = [F.col(a).alias(b) for a, b in (("node", side), ("n", f"n_{side}"), ("sketch", f"sketch_{side}"))]
        pairs = pairs.join(nodes.select(*own), side)
    return stage(pairs.mapInArrow(_promising(percent), "a long, b long"))


def _sets_of(docs: DataFrame, names: DataFrame, size: int) -> DataFrame:
    """node and its shingles, for the documents named by the column node."""
    names = stage(names.select(F.col("node").alias("doc_id")).distinct())
    return stage(docs.join(names, "doc_id").mapInArrow(_sets(size), "node long, shingles array<long>"))


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the threshold."""
    for side in "ab":
        pairs = pairs.join(sets.select(F.col("node").alias(side), F.col("shingles").alias(f"set_{side}")), side)
    common = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - common
    return stage(pairs.where(100 * common >= percent * union).select("a", "b"))


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    A document's set holds its distinct shingles of size words, lower-cased A-Z; a shorter one
    is a single shingle. Documents whose sets have a Jaccard similarity of at least percent
    are linked; component_id is the smallest doc_id reachable and kept marks that document.

    A null or wordless text has an empty set, links with nothing and is kept. A row without
    doc_id links with nothing, has no component and is kept. Repeated rows get one row each.
    A doc_id that carries several texts and is the smallest in their components joins them.
    Other columns are ignored. Shingles are compared as 64-bit hashes. The result is staged; what
    it was made from is deleted.
    """
    return staged_alone(docs.sparkSession, lambda: _near_duplicates(docs, size, percent))


def _near_duplicates(docs: DataFrame, size: int, percent: int) -> DataFrame:
    docs = docs.select("doc_id", "text")
    with staged(docs.mapInArrow(_sketches(size), "doc_id long, n_shingles long, digest binary, sketch binary")) as sketches:
        rows = stage(sketches.select("doc_id", "n_shingles", "digest"))
        usable = sketches.where("doc_id is not null and n_shingles > 0")
        least = F.min(F.struct("doc_id", "n_shingles", "sketch"))
        nodes = usable.groupBy("digest").agg(least.alias("least"))
        node, n = F.col("least.doc_id").alias("node"), F.col("least.n_shingles").alias("n")
        nodes = stage(nodes.select("digest", node, n, "least.sketch"))
    width = 2 * ROWS
    numbers = F.explode(F.sequence(F.lit(0), F.lit(REGISTERS // ROWS - 1)))
    bands = (
        nodes.select("node", "sketch", numbers.alias("band"))
        .select("node", "band", F.expr(f"substring(sketch, band * {width} + 1, {width})").alias("part"))
        .select(F.xxhash64("band", "part").alias("key"), "node")
    )
    centre = bands.groupBy("key").agg(F.min("node").alias("centre"), F.max("node").alias("most"))
    centre = centre.where("centre < most").drop("most")
    shared = stage(bands.join(centre, "key"))
    best = (
        shared.where("node > centre")
        .groupBy("node", "centre")
        .agg(F.count("*").alias("bands"))
        .groupBy("node")
        .agg(F.max(F.struct("bands", (-F.col("centre")).alias("centre"))).alias("best"))
    )
    pairs = _likely(nodes, best.select(F.col("node").alias("a"), (-F.col("best.centre")).alias("b")), percent)
    sets = _sets_of(docs, pairs.select(F.explode(F.array("a", "b")).alias("node")), size)
    links = _linked(pairs, sets, percent)
    found = stage(components(links))
    links = links.unionByName(_between_components(docs, shared, found, size, percent))
    found = stage(components(links))
    label = nodes.join(found, "node", "left").select("digest", F.coalesce("component", "node").alias("label"))
    labelled = rows.join(label, "digest", "left")
    own = F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("label")).otherwise(F.col("doc_id"))
    return labelled.select("doc_id", "n_shingles", own.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def _between_components(docs: DataFrame, shared: DataFrame, found: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) between nodes that share a band, or are near others that do, in different components.

    Only shingles that several components hold can join two of them, so nodes that hold the same
    such shingles make a class, however many they are: a passage that very many documents copy is
    one class or few. Two nodes are linked if what their classes have in common, o, reaches
    (n + m) * percent / (100 + percent), so a class's smallest node has every link that another
    node of it has. Classes are joined by their smallest nodes, and each other node gets the
    partner that lets the largest nodes in: its class's smallest node if that is near enough, or
    the smallest node of the class that reaches farthest. No component is lost by that.
    """
    placed = shared.join(found, "node", "left")
    placed = placed.select("key", "node", F.coalesce("component", "node").alias("component"))
    mixed = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    open_ = stage(placed.join(mixed.where("low < high").select("key"), "key").select("node", "component").distinct())
    sets = _sets_of(docs, open_, size)
    single = sets.join(open_, "node")
    single = single.select("node", "component", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    rarity = single.groupBy("shingle").agg(
        F.count("*").alias("sets"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    rarity = rarity.where("low < high").select("shingle", "sets")
    ordered = (
        single.join(rarity, "shingle")
        .groupBy("node", "component", "n")
        .agg(F.array_sort(F.collect_list(F.struct("sets", "shingle"))).alias("common"))
        # A partner has at least percent / 100 of the node's size, so that much must be in common.
        .where(f"100 * size(common) >= n * {percent}")
        .select("node", "component", "n", F.expr("transform(common, x -> x.shingle)").alias("common"))
    )
    name = F.md5(F.array_join(F.col("common").cast("array<string>"), ","))
    ordered = stage(ordered.withColumn("class", name))
    least = ordered.groupBy("class").agg(
        F.min(F.struct("n", "node")).alias("least"),
        F.min("component").alias("low"),
        F.max("component").alias("high"),
    )
    least = stage(least.select("class", "low", "high", F.col("least.node").alias("smallest"), F.col("least.n").alias("least_n")))
    pairs = _linked_classes(ordered, least, percent)
    members = ordered.select("node", "class", "n", F.size("common").alias("c")).join(least, "class")
    members = members.where("node != smallest")
    inside = members.where(f"(n + least_n) * {percent} <= c * {100 + percent}")
    # How large a node of a class may be to be linked with the other class's smallest one.
    reach = pairs.select(
        F.col("a").alias("smallest"), F.col("b").alias("other"), F.expr(f"common * {100 + percent} div {percent} - n_b").alias("reach")
    ).unionByName(
        pairs.select(
            F.col("b").alias("smallest"), F.col("a").alias("other"), F.expr(f"common * {100 + percent} div {percent} - n_a").alias("reach")
        )
    )
    farthest = reach.groupBy("smallest").agg(F.max(F.struct("reach", "other")).alias("far"))
    outside = members.join(farthest, "smallest").where("n <= far.reach")
    return stage(
        pairs.select("a", "b")
        .unionByName(inside.select(F.col("node").alias("a"), F.col("smallest").alias("b")))
        .unionByName(outside.select(F.col("node").alias("a"), F.col("far.other").alias("b")))
    )


def _linked_classes(ordered: DataFrame, least: DataFrame, percent: int) -> DataFrame:
    """Smallest nodes (a, b) of linked classes, their sizes and how many shingles they have in common.

    Two linked sets of n and m shingles have at least t = (n + m) * percent / (100 + percent) in
    common. With the shingles of all sets in one order, each set's first n - n * percent / 100 + 1
    then share one. Shingles of one component only come first in the order: they are in no other
    set and pair nothing. Of the others the rarer come first, so few sets meet at a shingle. A
    pair also needs t shingles that other components have, and t from the shared one on; a set
    for which even the smallest set at a shingle is too large for that does not take part there.
    """
    nodes = least.join(ordered.select(F.col("node").alias("smallest"), "common"), "smallest")
    nodes = stage(nodes.select(F.col("smallest").alias("node"), F.col("least_n").alias("n"), "low", "high", "common"))
    # Place of a shingle in its set's order: the n - size(common) others come before it.
    length = F.expr(f"size(common) - (n * {percent} + 99) div 100 + 1")
    first = nodes.where(length > 0).withColumn("c", F.size("common"))
    first = first.select("node", "n", "low", "high", "c", F.posexplode(F.slice("common", 1, length)).alias("pos", "shingle"))
    first = stage(first.withColumn("left", F.col("c") - F.col("pos")).drop("pos", "c"))
    sizes = first.groupBy("shingle").agg(F.count("*").alias("sets"), F.min("n").alias("smallest_n")).where("sets > 1")
    first = first.join(sizes, "shingle").where(f"(n + smallest_n) * {percent} <= left * {100 + percent}")
    first = stage(first.drop("sets", "smallest_n"))
    columns = ["node", "n", "low", "high", "left"]
    one, two = (first.select("shingle", *[F.col(x).alias(f"{x}_{side}") for x in columns]) for side in "ab")
    enough = f"(n_a + n_b) * {percent} <= least(left_a, left_b) * {100 + percent}"
    apart = "least(low_a, low_b) < greatest(high_a, high_b)"
    pairs = one.join(two, "shingle").where(f"node_a > node_b and {apart} and {enough}")
    pairs = stage(pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct())
    for side in "ab":
        own = [F.col(x).alias(y) for x, y in (("node", side), ("n", f"n_{side}"), ("common", f"set_{side}"))]
        pairs = pairs.join(nodes.select(*own), side)
    pairs = pairs.select("a", "b", "n_a", "n_b", F.size(F.array_intersect("set_a", "set_b")).alias("common"))
    return stage(pairs.where(f"(n_a + n_b) * {percent} <= common * {100 + percent}"))


def drop_near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """docs with all its columns, one document of each component of near_duplicates, and no row twice."""
    gone = near_duplicates(docs, size, percent).where("not kept").select("doc_id").distinct()
    left = docs.join(stage(gone), "doc_id", "left_anti").select(docs.columns)
    # Rows that repeat a doc_id are few, so only they are compared in full.
    again = stage(docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"))
    return left.join(again, "doc_id", "left_anti").unionByName(left.join(again, "doc_id", "left_semi").dropDuplicates())
