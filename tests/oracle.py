"""Compare a registered query with its SQL, row by row and type by type."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _cell(v):
    if v is None:
        return "null"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v + 0.0 if v else 0.0)
    return str(v)


def _rows(table) -> list[tuple[str, ...]]:
    names = sorted(table.column_names)
    columns = [[_cell(v) for v in table.column(n).to_pylist()] for n in names]
    return sorted(zip(*columns, strict=True))


def _kind(t) -> str:
    return str(t).replace("large_", "")


def differences(spark_df, con, sql: str, limit: int = 5) -> list[str]:
    """What differs between the two results; empty when they agree."""
    ours = spark_df.toArrow()
    theirs = con.sql(sql).to_arrow_table()
    if sorted(ours.column_names) != sorted(theirs.column_names):
        return [f"columns {ours.column_names} and {theirs.column_names}"]
    found = [
        f"type of {n}: {_kind(ours.schema.field(n).type)} and {_kind(theirs.schema.field(n).type)}"
        for n in ours.column_names
        if _kind(ours.schema.field(n).type) != _kind(theirs.schema.field(n).type)
    ]
    a, b = _rows(ours), _rows(theirs)
    if len(a) != len(b):
        found.append(f"{len(a)} rows and {len(b)} rows")
    if a != b:
        left, right = set(a) - set(b), set(b) - set(a)
        found.append(f"only ours {sorted(left)[:limit]}, only SQL {sorted(right)[:limit]}")
    return found
