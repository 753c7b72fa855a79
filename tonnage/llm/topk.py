"""Exact top-k by inner product, score at a time over an index ordered by impact.

Each block of rows has a posting list for each dimension: its rows by the level of their component,
so that a segment of the list is the rows of one level. A query turns a segment into an impact: the
least and the most that a component of that level adds to a score, counted from the end of the
dimension where it adds least. Segments are taken by descending impact, whatever their dimension, and
their least impact is summed per row. What the segments not yet taken and the width of the levels
can still add is one number, so at any time the sums bound every score on both sides. A search of a
block ends when that proves all rows but a few out, and the few are scored exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tonnage.llm.vectors import (
    BATCH_QUERIES,
    check_width,
    each_of,
    integer_vectors,
    matrix,
    parts,
    parts_for,
    products,
)
from tonnage.sources.staging import stage, staged

#: Rows of a block, about.
BLOCK_ROWS = 1 << 14
#: Levels of a dimension in a block: as many as these bits tell apart, or fewer.
LEVEL_BITS = 6
#: Shares of a block's postings after which the possible members are counted.
LOOKS = (0.75, 0.9375, 1.0)
#: A search ends once the possible members are k times one of these, or a share of the block.
FEW_TIMES = 4
FEW_SHARE = 32

INDEX_SCHEMA = (
    "size int, block int, dimension int, low long, shift int, "
    "numbers binary, starts binary, components binary, ids array<long>, rows array<long>"
)


def _posting_list(component: np.ndarray) -> tuple[int, int, np.ndarray, np.ndarray]:
    """Least component, bits below a level, rows by level, and where each level's rows begin."""
    low = int(component.min())
    shift = max(int(component.max() - low).bit_length() - LEVEL_BITS, 0)
    level = (component - low) >> shift
    order = np.argsort(level, kind="stable")
    return low, shift, order, np.searchsorted(level[order], np.arange(int(level.max()) + 2))


def _index_block(table: pa.Table) -> pa.Table:
    """The rows of the index for a block: one with the rows' names, and one for each dimension."""
    size, block = table["size"][0].as_py(), table["block"][0].as_py()
    keys = [("vec_id", "ascending"), ("row", "ascending")]
    table = table.take(pc.sort_indices(table, sort_keys=keys, null_placement="at_end"))
    x = matrix(table["x"], size)
    empty = np.zeros(0, np.int64)
    dimensions = [(-1, 0, 0, empty, empty, empty)]
    for d in range(size):
        low, shift, order, starts = _posting_list(x[:, d])
        dimensions.append((d, low, shift, order, starts, x[:, d]))
    number, low, shift, order, starts, component = zip(*dimensions, strict=True)
    blobs = [pa.array([y.astype("<i4").tobytes() for y in z], pa.binary()) for z in (order, starts, component)]
    names = [pa.array([table[c].to_pylist()] + [None] * size, pa.list_(pa.int64())) for c in ("vec_id", "row")]
    count = size + 1
    columns = [np.full(count, size, np.int32), np.full(count, block, np.int32), np.array(number, np.int32)]
    columns = [pa.array(c) for c in columns] + [pa.array(low, pa.int64()), pa.array(shift, pa.int32()), *blobs, *names]
    return pa.table(columns, [c.split()[0] for c in INDEX_SCHEMA.split(", ")])


def index_vectors(rows: DataFrame, block_count: int) -> DataFrame:
    """The index of rows (vec_id, row, size, x) in so many blocks, as a lazy table; to be staged.

    Rows are dealt out by their number, so equal vectors and equal ids spread over all blocks.
    Vectors of different sizes never meet; each size has blocks of its own.
    """
    return rows.withColumn("block", parts("row", block_count)).groupBy("size", "block").applyInArrow(_index_block, INDEX_SCHEMA)


class Block:
    """The posting lists of a block, from either end of each dimension, and its rows' components."""

    def __init__(self, x: np.ndarray, low: np.ndarray, shift: np.ndarray, order: list[np.ndarray], starts: list[np.ndarray]):
        self.x = x
        high = x.max(axis=0)
        most = max((len(s) for s in starts), default=1)
        # [0] is for weights above 0, whose best rows have the last level, [1] for those below 0.
        # Segments stand best first: the least and the most that a row of each adds for a weight of
        # one, and where its rows begin. After the last segment stand empty ones.
        self.least, self.most = np.zeros((2, 2, x.shape[1], most), np.int64)
        self.starts = np.zeros((2, x.shape[1], most + 1), np.int64)
        self.order, self.segment = ([], []), ([], [])
        for d, begin in enumerate(starts):
            count, levels = np.diff(begin), len(begin) - 1
            first = low[d] + (np.arange(levels) << shift[d])
            last = np.minimum(first + (1 << shift[d]) - 1, high[d])
            ends = ((first - low[d])[::-1], (last - low[d])[::-1], count[::-1], order[d][::-1])
            for side, (a, b, n, rows) in enumerate((ends, (high[d] - last, high[d] - first, count, order[d]))):
                self.least[side, d, :levels], self.most[side, d, :levels] = a, b
                self.starts[side, d, 1 : levels + 1] = np.cumsum(n)
                self.starts[side, d, levels + 1 :] = len(rows)
                self.order[side].append(np.ascontiguousarray(rows))
                self.segment[side].append(np.repeat(np.arange(levels), n))

    def possible(self, q: np.ndarray, k: int, own: np.ndarray) -> np.ndarray:
        """Numbers of the rows that may be among the k of highest product with q; never one of own."""
        count = len(self.x)
        used = np.flatnonzero(q)
        if count - len(own) <= k or not len(used):
            return np.setdiff1d(np.arange(count), own)
        side, weight = (q[used] < 0).astype(int), np.abs(q[used])[:, None]
        least, most = weight * self.least[side, used], weight * self.most[side, used]
        starts = self.starts[side, used]
        # All segments by descending impact; the share of the postings up to each tells when to look.
        descending = np.argsort(most, axis=None)[::-1]
        filled = np.cumsum(np.diff(starts).ravel()[descending])
        lines = most.ravel()[descending[np.searchsorted(filled, np.array(LOOKS) * filled[-1])]]
        lines[-1] = 0
        width = (most - least).max(axis=1)
        taken = np.zeros(len(used), np.int64)
        sums = np.zeros(count, np.int64)
        for line in lines.tolist():
            to = (most >= line).sum(axis=1)
            for i, d in enumerate(used.tolist()):
                a, b = starts[i, taken[i]], starts[i, to[i]]
                if a < b:
                    sums[self.order[side[i]][d][a:b]] += least[i][self.segment[side[i]][d][a:b]]
            taken = to
            # A row of a segment not taken adds as much as the next one, one of a taken one the level's width.
            next_ = np.where(to < most.shape[1], most[np.arange(len(used)), np.minimum(to, most.shape[1] - 1)], 0)
            rest = int(np.maximum(next_, width).sum())
            others = np.delete(sums, own)
            bound = np.partition(others, len(others) - k)[len(others) - k]
            found = np.flatnonzero(sums + rest >= bound)
            if len(found) <= max(FEW_TIMES * k, count // FEW_SHARE):
                break
        return np.setdiff1d(found, own)


def _load(table: pa.Table, size: int) -> tuple[Block, pa.Array, np.ndarray]:
    """A block, its rows' ids and their numbers, from the rows of the index."""
    place = np.argsort(table["dimension"].to_numpy()).tolist()
    ids, rows = (table[c][place[0]].values for c in ("ids", "rows"))

    def arrays(column: str) -> list[np.ndarray]:
        return [np.frombuffer(table[column][i].as_buffer(), "<i4").astype(np.int64) for i in place[1:]]

    x = np.stack([np.zeros((len(ids), 0), np.int64)] if not size else arrays("components"), axis=-1)
    low, shift = (table[c].to_numpy()[place[1:]] for c in ("low", "shift"))
    return Block(x.reshape(len(ids), size), low, shift, arrays("numbers"), arrays("starts")), ids, rows.to_numpy()


FOUND_SCHEMA = "query_id long, query_row long, vec_id long, row long, score long"


def _search(k: int):
    def pairs(key: tuple, queries: pa.Table, index: pa.Table) -> pa.Table:
        names = [c.split()[0] for c in FOUND_SCHEMA.split(", ")]
        found: list[list] = [[] for _ in names]
        if queries.num_rows and index.num_rows:
            size = key[0].as_py()
            block, ids, rows = _load(index, size)
            asked = matrix(queries["x"], size)
            check_width(block.x, asked)
            for q, query_id, query_row in zip(asked, queries["vec_id"], queries["row"], strict=True):
                own = np.flatnonzero(rows == query_row.as_py())
                member = block.possible(q, k, own)
                score = products(block.x[member], q[None, :])[:, 0]
                # Rows of a block stand by their ids, so a lower number wins a tie.
                best = np.lexsort((member, -score))[:k]
                member, score = member[best], score[best]
                values = [np.full(len(best), query_id.as_py()), np.full(len(best), query_row.as_py())]
                for column, value in zip(found, [*values, ids.take(pa.array(member)), rows[member], score], strict=True):
                    column.append(value if isinstance(value, pa.Array) else pa.array(value))
        columns = [pa.concat_arrays([pa.array([], pa.int64()), *c]) for c in found]
        return pa.table(columns, names)

    return pairs


def search(index: DataFrame, queries: DataFrame, block_count: int, k: int = 10) -> DataFrame:
    """For each row of queries (vec_id, row, size, x) its k rows of highest product in the index.

    Rows query_id, rank, vec_id, score; the query's own row, told by its number, does not count.
    Equal scores rank by ascending vec_id, a null one last. Batches of queries meet blocks of the
    index, each in one task, so neither side is broadcast or held whole; of each block a query
    brings k rows to the end.
    """
    batch_count = parts_for(queries.count(), BATCH_QUERIES)
    asked = queries.withColumn("batch", parts("row", batch_count)).withColumn("block", each_of(block_count))
    blocks = index.withColumn("batch", each_of(batch_count))
    keys = ["size", "block", "batch"]
    found = asked.groupBy(*keys).cogroup(blocks.groupBy(*keys)).applyInArrow(_search(k), FOUND_SCHEMA)
    line = W.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    ranked = found.withColumn("rank", F.row_number().over(line)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def top_k(vectors: DataFrame, every: int = 100, scale: int = 1024, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose vec_id is divisible by every its k best others.

    vectors has vec_id and embedding; a component counts as floor(scale * component), and the score
    is the inner product of these, exactly. Rows without a vector, or with a null or infinite
    component or NaN, take no part; a null vec_id asks nothing, but may be found. Rows that share
    a vec_id are rows of their own: each asks, and may be found by the others. Vectors of different
    sizes do not meet. A component of 2^31 or more once scaled, and products that do not fit into 64
    bits, stop the job. Other columns are ignored; without rows there is no result.
    """
    rows = stage(integer_vectors(vectors, "embedding", scale, [F.col("vec_id").cast("long").alias("vec_id")]))
    block_count = parts_for(rows.count(), BLOCK_ROWS)
    with staged(index_vectors(rows, block_count)) as index:
        return stage(search(index, rows.where(F.col("vec_id") % every == 0), block_count, k))
