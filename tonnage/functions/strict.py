"""Column expressions with strict missing-value rules.

Spark skips nulls in aggregates, treats an unknown condition as false and raises
on division by zero. The analytical operators need the opposite: a missing input
makes the result missing, and arithmetic follows IEEE 754. Every function returns
a plain built-in expression without a Python function.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _complete(c: Column) -> Column:
    return F.count(c) == F.count(F.lit(1))


def strict_sum(c: ColumnOrName) -> Column:
    """Sum that is null as soon as one value in the group is null."""
    c = _col(c)
    return F.when(_complete(c), F.sum(c))


def strict_mean(c: ColumnOrName) -> Column:
    """Mean that is null as soon as one value in the group is null."""
    c = _col(c)
    return F.when(_complete(c), F.avg(c))


def r_divide(x: ColumnOrName, y: ColumnOrName) -> Column:
    """x / y on doubles where x / 0 is +-Infinity and 0 / 0 is NaN."""
    x, y = _col(x).cast("double"), _col(y).cast("double")
    return F.when(y == 0, x * F.pow(y, F.lit(-1.0))).otherwise(F.try_divide(x, y))


def r_log(x: ColumnOrName) -> Column:
    """Natural logarithm where log(0) is -Infinity and log of a negative is NaN."""
    x = _col(x).cast("double")
    return (
        F.when(x == 0, F.lit(float("-inf")))
        .when(x < 0, F.lit(float("nan")))
        .otherwise(F.ln(x))
    )


def if_else(cond: Column, yes: ColumnOrName, no: ColumnOrName) -> Column:
    """Two-way choice that is null when the condition is unknown."""
    return F.when(cond, _col(yes)).when(~cond, _col(no))


def is_missing(c: ColumnOrName) -> Column:
    """Null or NaN, for a floating-point column."""
    c = _col(c)
    return c.isNull() | F.isnan(c)


def strict_less(x: ColumnOrName, y: ColumnOrName) -> Column:
    """x < y on floating-point columns; null when either side is null or NaN.

    Spark counts NaN as larger than every number.
    """
    x, y = _col(x), _col(y)
    return F.when(~(is_missing(x) | is_missing(y)), x < y)


def zero_if_missing(c: ColumnOrName) -> Column:
    """The value, or 0 where it is null or NaN."""
    c = _col(c).cast("double")
    return F.coalesce(F.nanvl(c, F.lit(None).cast("double")), F.lit(0.0))


def is_in(c: ColumnOrName, values: Iterable) -> Column:
    """Membership that is false, never unknown, for a null value."""
    return F.coalesce(_col(c).isin(list(values)), F.lit(False))


def not_in(c: ColumnOrName, values: Iterable) -> Column:
    """Negated membership that keeps null values."""
    return ~is_in(c, values)


def label(*parts: ColumnOrName, sep: str = "") -> Column:
    """Joined text in which a missing part reads NA."""
    texts = [F.coalesce(_col(p).cast("string"), F.lit("NA")) for p in parts]
    return F.concat_ws(sep, *texts)


def recode(c: ColumnOrName, mapping: Mapping) -> Column:
    """Replace each listed value; anything else becomes null."""
    c = _col(c)
    (first, new), *rest = mapping.items()
    out = F.when(c == first, F.lit(new))
    for old, new in rest:
        out = out.when(c == old, F.lit(new))
    return out


# A decimal number with an optional sign, fraction and exponent, or a special value.
NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity|nan))\s*$"
# Groups of three digits parted by commas.
GROUPED = r"^\s*[+-]?\d{1,3}(,\d{3})+(\.\d*)?\s*$"


def to_number(c: ColumnOrName) -> Column:
    """Text to double; text that is not one plain number is null, grouping commas included."""
    text = _col(c).cast("string")
    return F.when(text.rlike(NUMBER), F.trim(text).try_cast("double"))


def parse_grouped(c: ColumnOrName) -> Column:
    """Text to double as a CSV reader does it: commas may part groups of three digits."""
    text = _col(c).cast("string")
    bare = F.when(text.rlike(GROUPED), F.replace(text, F.lit(","), F.lit(""))).otherwise(text)
    return to_number(bare)


def piece(c: ColumnOrName, pattern: str, position: int) -> Column:
    """One piece (from 1) of a text split by a regular expression, or null."""
    return F.try_element_at(F.split(_col(c), pattern), F.lit(position))
