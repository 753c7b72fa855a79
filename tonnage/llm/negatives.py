"""Hard negatives: rows of another label that score a little below an anchor's positives.

The top node of a multiway hyperplane tree (see gnat) is fitted on a bounded sample and stored
with ranges over all rows; it deals all rows out to its subtrees, and these, in blocks, to tasks. A task
makes the lower levels for its block, which takes less time than to read them, and answers the anchors that
the top node's ranges let through. This happens twice: for the positives, with no window
but a floor that the sample gives, and for the negatives, with one window for each positive.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tonnage.llm.gnat import NONE, NUMBER_BITS, WIDE, Queries, Split, Tree, distances, split_points
from tonnage.llm.vectors import BATCH_QUERIES, each_of, integer_vectors, matrix, parts, parts_for, products
from tonnage.sources.staging import stage, staged

#: Rows of the sample that the top node's split points and the first floors come from, at most.
SAMPLE_ROWS = 1 << 11
#: Split points of the top node, at most, and rows of a block, about.
TOP_FAN = 64
BLOCK_ROWS = 1 << 12

ROW_SCHEMA = "vec_id long, label long, row long, size int, x array<int>"


@dataclass
class Top:
    """The top node over vectors of one size, and the sample. Vectors of other sizes form one more cell."""

    size: int
    split: Split
    sample: np.ndarray
    labels: np.ndarray
    rows: np.ndarray
    #: Blocks of each cell, that of the other sizes last.
    blocks: np.ndarray

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        far = distances(self.split.points, x)
        return np.argmin(far, axis=1), far


def _by_size(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    size = batch.column("size").to_numpy()
    for n in np.unique(size).tolist():
        yield n, batch.filter(pa.array(size == n))


def _fit(rows: DataFrame, count: int) -> Top:
    """Split points from a sample of the rows whose numbers hash lowest, without ranges yet."""
    sample = rows.orderBy(F.xxhash64("row")).limit(SAMPLE_ROWS).toArrow().combine_chunks()
    sample = sample.sort_by("row")
    sizes, often = np.unique(sample["size"].to_numpy(), return_counts=True)
    size = int(sizes[np.argmax(often)]) if len(sizes) else 0
    sample = sample.filter(pa.array(sample["size"].to_numpy() == size))
    x = matrix(sample["x"], size)
    fan = min(TOP_FAN, parts_for(count, BLOCK_ROWS))
    points = split_points(x, fan, np.random.Generator(np.random.PCG64(13))) if len(x) else x
    names = [sample[c].to_numpy() for c in ("label", "row")]
    return Top(size, Split.empty(points), x, *names, np.ones(len(points) + 1, np.int64))


def _filed(top: Top):
    """Rows with the cell that they belong to."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, part in _by_size(batch):
                cell = np.full(len(part), len(top.split.points))
                if size == top.size:
                    cell = top.cells(matrix(part.column("x"), size))[0]
                yield part.append_column("cell", pa.array(cell.astype(np.int32)))

    return rows


RANGE_SCHEMA = "cell int, point int, nearest double, farthest double, least_norm double, most_norm double, rows long"


def _ranged(top: Top):
    """What the rows of each batch add to the top node's ranges: a row for each cell and split point."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, part in _by_size(batch):
                fan = len(top.split.points)
                if size != top.size:
                    columns = [[fan], [0], [0.0], [0.0], [0.0], [0.0], [len(part)]]
                else:
                    x = matrix(part.column("x"), size)
                    cell, far = top.cells(x)
                    split = Split.empty(top.split.points)
                    split.widen(far, cell, x)
                    met, counts = np.unique(cell, return_counts=True)
                    columns = [np.repeat(met, fan), np.tile(np.arange(fan), len(met))]
                    columns += [split.nearest[:, met].T.ravel(), split.farthest[:, met].T.ravel()]
                    columns += [np.repeat(v, fan) for v in (split.least_norm[met], split.most_norm[met], counts)]
                names = [c.split()[0] for c in RANGE_SCHEMA.split(", ")]
                kinds = [pa.int32(), pa.int32(), *[pa.float64()] * 4, pa.int64()]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return rows


def fit_top(rows: DataFrame, count: int) -> Top:
    """The top node over rows, its ranges and its cells' sizes taken from all of them.

    The driver gets the sample, and a row for each two of at most TOP_FAN split points.
    """
    top = _fit(rows, count)
    ranges = rows.mapInArrow(_ranged(top), RANGE_SCHEMA).groupBy("cell", "point").agg(
        F.min("nearest").alias("nearest"), F.max("farthest").alias("farthest"),
        F.min("least_norm").alias("least_norm"), F.max("most_norm").alias("most_norm"), F.sum("rows").alias("rows"),
    )
    for r in ranges.collect():
        top.blocks[r.cell] = parts_for(r.rows, BLOCK_ROWS)
        if r.cell < len(top.split.points):
            top.split.nearest[r.point, r.cell], top.split.farthest[r.point, r.cell] = r.nearest, r.farthest
            top.split.least_norm[r.cell], top.split.most_norm[r.cell] = r.least_norm, r.most_norm
    return top


def _windows(batch: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The windows of each query; queries with fewer than others get windows that hold nothing."""
    lists = [batch[c].combine_chunks() if isinstance(batch, pa.Table) else batch.column(c) for c in ("low", "high")]
    count = np.diff(lists[0].offsets.to_numpy())
    most = int(count.max(initial=0))
    there = np.arange(most) < count[:, None]
    out = np.full((2, len(count), most), WIDE)
    out[1] = -WIDE
    for part, values in zip(out, lists, strict=True):
        part[there] = values.flatten().to_numpy()
    return out[0], out[1]


def _floors(top: Top, x: np.ndarray, label: np.ndarray, row: np.ndarray, k: int) -> np.ndarray:
    """For each query a score that k rows of its label reach, by the sample, or the lowest."""
    score = products(x, top.sample)
    fits = (label[:, None] == top.labels) & (row[:, None] != top.rows)
    score = np.where(fits, score, -WIDE)
    return np.partition(score, -k, axis=1)[:, -k] if score.shape[1] >= k else np.full(len(x), -WIDE)


def _sent(top: Top, same: bool, k: int):
    """Queries once for each cell that they may find something in, with that cell's number of blocks."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, part in _by_size(batch):
                fan = len(top.split.points)
                if size == top.size and fan:
                    x = matrix(part.column("x"), size)
                    low, high = _windows(part)
                    if same:
                        floor = _floors(top, x, part.column("label").to_numpy(), part.column("row").to_numpy(), k)
                        low = np.maximum(low, floor[:, None])
                    query, cell = np.nonzero(top.split.reached(x, low, high))
                else:
                    query, cell = np.arange(len(part)), np.full(len(part), fan)
                sent = part.take(pa.array(query))
                sent = sent.append_column("cell", pa.array(cell.astype(np.int32)))
                yield sent.append_column("blocks", pa.array(top.blocks[cell].astype(np.int32)))

    return rows


FOUND_SCHEMA = "query_row long, window int, vec_id long, row long, score long"


def _answer(same: bool, k: int):
    def found(key: tuple, queries: pa.Table, rows: pa.Table) -> pa.Table:
        columns: list[pa.Array] = [pa.array([], pa.int64()) for _ in range(5)]
        if queries.num_rows and rows.num_rows:
            size = key[0].as_py()
            order = [("vec_id", "ascending"), ("row", "ascending")]
            rows = rows.take(pc.sort_indices(rows, sort_keys=order, null_placement="at_end"))
            number = rows["row"].to_numpy()
            asked = queries["row"].to_numpy()
            by_number = np.argsort(number)
            at = by_number[np.minimum(np.searchsorted(number, asked, sorter=by_number), len(number) - 1)]
            own = np.where(number[at] == asked, at, -1)
            low, high = _windows(queries)
            tree = Tree(matrix(rows["x"], size), rows["label"].to_numpy())
            ask = Queries(matrix(queries["x"], size), queries["label"].to_numpy(), own, low, high, same, k)
            tree.search(ask)
            query, window, place = np.nonzero(ask.best != NONE)
            best = ask.best[query, window, place]
            local = (1 << NUMBER_BITS) - 1 - (best & ((1 << NUMBER_BITS) - 1))
            columns = [pa.array(asked[query]), pa.array(window), rows["vec_id"].combine_chunks().take(pa.array(local))]
            columns += [pa.array(number[local]), pa.array(best >> NUMBER_BITS)]
        columns[1] = columns[1].cast(pa.int32())
        return pa.table(columns, [c.split()[0] for c in FOUND_SCHEMA.split(", ")])

    return found


def windowed(queries: DataFrame, rows: DataFrame, top: Top, same: bool, k: int) -> DataFrame:
    """The k rows of highest score in each window of each query, of its own label or of others.

    queries has the columns of rows, and low and high, lists of windows; the result has query_row,
    window (its place in the lists), vec_id, row, score and rank. Only blocks of cells that a query
    may find something in meet it, batch by batch, each pair in one task.
    """
    batches = parts_for(queries.count(), BATCH_QUERIES)
    schema = f"{ROW_SCHEMA}, low array<long>, high array<long>, cell int, blocks int"
    columns = ["vec_id", "label", "row", "size", "x", "low", "high"]
    sent = queries.select(columns).mapInArrow(_sent(top, same, k), schema)
    sent = sent.withColumn("batch", parts("row", batches)).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = F.element_at(F.lit(top.blocks.tolist()).cast("array<int>"), F.col("cell") + 1)
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("row"), dealt).cast("int")).withColumn("batch", each_of(batches))
    keys = ["size", "cell", "block", "batch"]
    found = sent.drop("blocks").groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInArrow(_answer(same, k), FOUND_SCHEMA)
    line = W.partitionBy("query_row", "window").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return found.withColumn("rank", F.row_number().over(line)).where(F.col("rank") <= k)


def _percent(score: str, percent: int, up: bool) -> Column:
    """That many hundredths of a whole score, rounded up or down to a whole number without doubles."""
    if up:
        return F.expr(f"({score} * {percent}L + pmod(-{score} * {percent}L, 100L)) div 100L")
    return F.expr(f"({score} * {percent}L - pmod({score} * {percent}L, 100L)) div 100L")


def mine_negatives(
    vectors: DataFrame,
    every: int = 50,
    scale: int = 256,
    positives: int = 5,
    negatives: int = 3,
    window: Sequence[int] = (50, 95),
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    vectors has vec_id, label and embedding; a component counts as floor(scale * component), a score
    is the inner product of these, and higher ones come first, equal ones by ascending vec_id, a null
    one last. Anchors are the rows whose vec_id is divisible by every. An anchor's positives are its
    first other rows of its label; for each, its negatives are the first rows of other labels whose
    score lies between the window's percentages of the positive's, both included.

    Rows without a label or a vector, or with a null or infinite component or NaN, take no part; a null
    vec_id is no anchor, but may be found. Rows that share a vec_id are rows of their own, told apart by
    number. An anchor without positives, and a positive without negatives, has no row. Vectors of
    different sizes do not meet. A component of 2^31 or more once scaled, and products of 2^46 or
    more, stop the job. Other columns are ignored; without rows there is no result.
    """
    usable = vectors.where(F.col("label").isNotNull())
    names = [F.col(c).cast("long").alias(c) for c in ("vec_id", "label")]
    with staged(integer_vectors(usable, "embedding", scale, names)) as plain:
        top = fit_top(plain, plain.count())
        rows = stage(plain.mapInArrow(_filed(top), f"{ROW_SCHEMA}, cell int"))
    anchors = rows.where(F.col("vec_id") % every == 0).drop("cell")
    anywhere = {c: F.array(F.lit(v).cast("long")) for c, v in (("low", -WIDE), ("high", WIDE))}
    near = stage(windowed(anchors.withColumns(anywhere), rows, top, True, positives))
    low, high = window
    spans = near.withColumns({"low": _percent("score", low, True), "high": _percent("score", high, False)})
    # One row for each anchor, with its positives in order.
    of_anchor = F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score", "low", "high"))).alias("positives")
    spans = spans.groupBy(F.col("query_row").alias("row")).agg(of_anchor)
    asks = anchors.join(spans, "row").withColumns({c: F.col(f"positives.{c}") for c in ("low", "high")})
    asks = stage(asks)
    far = windowed(asks, rows, top, False, negatives)
    far = far.select("query_row", "window", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    met = asks.select(F.col("row").alias("query_row"), F.col("vec_id").alias("anchor_id"), F.posexplode("positives").alias("window", "p"))
    return stage(far.join(met, ["query_row", "window"]).select(
        "anchor_id", F.col("p.vec_id").alias("positive_id"), "rank", "negative_id",
        F.col("p.score").alias("positive_score"), "negative_score",
    ))
