"""Integer vectors in blocks of rows, and the meeting of a stated set of queries with all blocks."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Queries of a batch, about: what one task holds of them.
BATCH_QUERIES = 1 << 12
#: Sums of products below this are exact in doubles, and so are their parts.
EXACT = 1 << 53
#: Further out, scores and bounds could leave 64 bits.
WIDEST = 1 << 60


def integer_vectors(df: DataFrame, vector: str, scale: int, columns: Sequence[Column]) -> DataFrame:
    """columns, row (a number of the row's own), size, and x: the components times scale, rounded down.

    Rows whose vector is null or holds a null or a component that is not finite are left out. A
    component beyond 32 bits once it is scaled stops the job. The numbers in row hold within
    one reading of df, so stage the result before it is used twice.
    """
    infinite = [F.lit(float(sign + "inf")) for sign in "+-"]
    scaled = F.col(f"`{vector}`").cast("array<double>")
    finite = F.forall(scaled, lambda v: v.isNotNull() & ~F.isnan(v) & ~v.isin(*infinite))
    x = F.transform(scaled, lambda v: F.floor(v * float(scale))).cast("array<int>")
    usable = df.where(F.col(f"`{vector}`").isNotNull() & finite)
    return usable.select(*columns, F.monotonically_increasing_id().alias("row"), F.size(scaled).alias("size"), x.alias("x"))


def parts(column: str, count: int) -> Column:
    """The number below count under which a row's column files it."""
    return F.pmod(F.xxhash64(column), F.lit(count)).cast("int")


def each_of(count: int) -> Column:
    """All numbers below count, a row for each."""
    return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))


def parts_for(rows: int, most: int) -> int:
    return max(-(-rows // most), 1)


def matrix(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    """The rows of a column of lists of one size."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), size)


def check_width(x: np.ndarray, q: np.ndarray) -> int:
    """A bound of all inner products of rows of x and q; an error if it is beyond what 64 bits hold."""
    widest = max(int(np.abs(x).max(initial=0)), 1) * max(int(np.abs(q).max(initial=0)), 1) * max(x.shape[1], 1)
    if widest >= WIDEST:
        raise OverflowError(f"inner products of up to {widest} do not fit into 64 bits with their bounds")
    return widest


def products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of the rows of x with those of q, exactly: one row for each of x."""
    if check_width(x, q) < EXACT:
        return (x.astype(np.float64) @ q.astype(np.float64).T).astype(np.int64)
    return x @ q.T
