"""For keys that a join would lose, the key on the other side that was most likely meant."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping, Sequence
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonnage.operators.joins import rows_without_match
from tonnage.operators.relational import quoted, require


@cache
def _plain_letters() -> tuple[str, str]:
    """All letters below U+2100 that are one plain letter with marks, and those plain letters."""
    found = {}
    for code in range(0x80, 0x2100):
        base = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c))
        if len(base) == 1 and base != chr(code) and base.isalpha():
            found[chr(code)] = base
    return "".join(found), "".join(found.values())


def normal_key(column: Column) -> Column:
    """A key without case, accents and punctuation, its words parted by single blanks."""
    plain = F.translate(column.cast("string"), *_plain_letters())
    bare = F.regexp_replace(plain, r"\p{M}+", "")
    return F.trim(F.regexp_replace(F.lower(bare), r"[^\p{L}\p{N}]+", " "))


def _without_letters(text: Column, edits: int) -> Column:
    """text and what is left of it without any one, two, ... of its characters."""
    def shorter(x: Column) -> Column:
        cuts = F.sequence(F.lit(1), F.char_length(x))
        each = F.transform(cuts, lambda i: F.concat(F.substring(x, F.lit(1), i - 1), F.substring(x, i + 1, F.char_length(x))))
        return F.when(F.char_length(x) > 0, each).otherwise(F.array().cast("array<string>"))

    level, found = F.array(text), [F.array(text)]
    for _ in range(edits):
        level = F.array_distinct(F.flatten(F.transform(level, shorter)))
        found.append(level)
    return F.array_distinct(F.flatten(F.array(*found)))


def repair_hints(
    left: DataFrame, right: DataFrame, on: Sequence[str] | Mapping[str, str], edits: int = 1
) -> DataFrame:
    """key, n_rows, hint, edits, n_hints: one row per key of left that right does not have.

    The hint is the key of right whose normal form is nearest, by Levenshtein distance, and at
    most edits away; of equally near ones it is the first in code point order, and n_hints says
    how many there are. A key with none has null as hint and edits, and 0 as n_hints. A missing key and one
    without letters or digits get no hint, and such keys of right are none.

    Keys within that distance have a common rest after at most so many characters are taken out
    of each, so they are joined on these rests; no other pairs are made. A key of n characters has
    n + 1 rests for one edit and about n * n / 2 for two. Each key counts once, however many
    rows have it. `on` is one column of text, or a mapping from left to right.
    """
    pairs = dict(on) if isinstance(on, Mapping) else {k: k for k in on}
    if len(pairs) != 1:
        raise ValueError(f"hints are for one key, not {list(pairs)}")
    if not 0 <= edits <= 2:
        raise ValueError(f"edits are 0, 1 or 2, not {edits}")
    (key, other), = pairs.items()
    require(left, [key])
    require(right, [other])
    lost = rows_without_match(left.select(quoted(key)), right, pairs).groupBy(quoted(key).alias("key"))
    lost = lost.agg(F.count(F.lit(1)).alias("n_rows"))
    theirs = right.select(quoted(other).cast("string").alias("hint")).where("hint is not null").distinct()

    def rests(df: DataFrame, column: str, normal: str) -> DataFrame:
        rows = df.select(column, normal_key(F.col(column)).alias(normal)).where(F.length(normal) > 0)
        return rows.withColumn("rest", F.explode(_without_letters(F.col(normal), edits)))

    near = rests(lost.select(F.col("key")), "key", "__own").join(rests(theirs, "hint", "__their"), "rest")
    distance = F.levenshtein("__own", "__their", edits)
    # The same pair may meet at several rests.
    near = near.select("key", "hint", distance.alias("edits")).where("edits >= 0").distinct()
    least = F.min(F.struct("edits", "hint"))
    counts = F.array(*[F.count_if(F.col("edits") == n) for n in range(edits + 1)])
    best = near.groupBy("key").agg(least.alias("__best"), counts.alias("__n"))
    best = best.select("key", "__best.hint", "__best.edits", F.expr("__n[__best.edits]").alias("n_hints"))
    hinted = lost.join(best, "key", "left")
    return hinted.select("key", "n_rows", "hint", "edits", F.coalesce("n_hints", F.lit(0).cast("long")).alias("n_hints"))
