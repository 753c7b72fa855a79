from __future__ import annotations

import io
import math
from contextlib import redirect_stdout


def plan(df) -> str:
    """The physical plan as text; the final one if the query has run."""
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


def cell(v):
    """A value that compares equal to itself even for NaN."""
    return "nan" if isinstance(v, float) and math.isnan(v) else v


def rows(df) -> list[tuple]:
    """All rows as tuples in a stable order, missing values first."""
    found = [tuple(cell(v) for v in r) for r in df.collect()]
    return sorted(found, key=lambda r: [(v is not None, str(v)) for v in r])


def as_dict(df, value: str, *keys: str) -> dict:
    """Value by key; a key that occurs twice is an error."""
    out = {}
    for r in df.collect():
        k = tuple(r[c] for c in keys)
        k = k[0] if len(k) == 1 else k
        assert k not in out, f"{k} occurs twice"
        out[k] = r[value]
    return out
