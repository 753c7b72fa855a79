"""Equi-joins in which a missing key matches a missing key.

No join carries a broadcast hint: Spark broadcasts a side when its known size is
under spark.sql.autoBroadcastJoinThreshold, and otherwise shuffles both sides and
lets adaptive execution split skewed partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonnage.operators.relational import missing_test, quoted, rename, require

Keys = Sequence[str] | Mapping[str, str] | None

_RIGHT_KEY = "__right_key_"
_MATCHED = "__matched"


def _key_pairs(left: DataFrame, right: DataFrame, on: Keys) -> dict[str, str]:
    if on is None:
        pairs = {c: c for c in left.columns if c in right.columns}
        if not pairs:
            raise ValueError(f"no shared column: {left.columns} and {right.columns}")
    elif isinstance(on, Mapping):
        pairs = dict(on)
    else:
        pairs = {k: k for k in on}
    require(left, pairs.keys())
    require(right, pairs.values())
    for k, r in pairs.items():
        kinds = [df.schema[c].dataType.simpleString() for df, c in ((left, k), (right, r))]
        if kinds[0] != kinds[1] and "string" in kinds:
            raise TypeError(f"cannot join {k} ({kinds[0]}) to {r} ({kinds[1]})")
    return pairs


def _same_keys(pairs: Mapping[str, str], nulls: str = "match") -> Column:
    """Equality of all keys. A plain one reuses a partitioning by the keys, a null-safe one cannot."""
    if nulls not in ("match", "never"):
        raise ValueError(f"nulls is match or never, not {nulls}")
    rights = [F.col(f"{_RIGHT_KEY}{i}") for i in range(len(pairs))]
    tests = [quoted(k) == r if nulls == "never" else quoted(k).eqNullSafe(r) for k, r in zip(pairs, rights, strict=True)]
    return reduce(lambda a, b: a & b, tests)


def _right_keys(right: DataFrame, pairs: Mapping[str, str]) -> DataFrame:
    return rename(right, {r: f"{_RIGHT_KEY}{i}" for i, r in enumerate(pairs.values())})


def _add_suffixes(
    left: DataFrame, right: DataFrame, pairs: Mapping[str, str], suffixes: tuple[str, str]
) -> tuple[DataFrame, DataFrame]:
    rest = [c for c in right.columns if c not in pairs.values()]
    clash = [c for c in rest if c in left.columns and c not in pairs]
    return (
        rename(left, {c: c + suffixes[0] for c in clash}),
        rename(right, {c: c + suffixes[1] for c in clash}),
    )


def _repeated_matches(df: DataFrame, keys: Sequence[str], other: DataFrame, other_keys: Sequence[str]) -> Column:
    """How many rows of other have a key that df holds more than once, as a scalar subquery.

    Only key columns take part, and only df's repeated keys meet the other side.
    """
    own = [quoted(k).alias(f"__own_{i}") for i, k in enumerate(keys)]
    repeated = df.select(*own).groupBy(*[f"__own_{i}" for i in range(len(keys))]).agg(F.count(F.lit(1)).alias("__n"))
    theirs = other.select(*[quoted(k).alias(f"__their_{i}") for i, k in enumerate(other_keys)])
    same = reduce(lambda a, b: a & b, (F.col(f"__their_{i}").eqNullSafe(F.col(f"__own_{i}")) for i in range(len(keys))))
    used = theirs.join(repeated.where(F.col("__n") > 1), same, "left_semi")
    return used.agg(F.count(F.lit(1)).alias("__used")).scalar()


def proved_unique(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether df's plan by itself says that no two of its rows have equal keys.

    So it is with keys that df was grouped by or made distinct on, also after filters, renaming
    and joins that add no rows. Spark's optimizer works this out, without reading any data.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    output = plan.output()
    names = {output.apply(i).exprId().id(): name for i, name in enumerate(df.columns)}
    sets = plan.distinctKeys().iterator()
    while sets.hasNext():
        members, found = sets.next().iterator(), set()
        while members.hasNext():
            member = members.next()
            found.add(names.get(member.exprId().id()) if member.nodeName() == "AttributeReference" else None)
        if found <= set(keys):
            return True
    return False


def _guarded(df: DataFrame, columns: Sequence[str], fine: Column, message: str) -> DataFrame:
    """df with columns that raise unless fine is true."""
    stop = F.raise_error(F.lit(message))
    return df.withColumns(
        {c: F.when(fine, quoted(c)).otherwise(stop.cast(df.schema[c].dataType)) for c in columns}
    )


def _check_expectation(
    joined: DataFrame, left: DataFrame, right: DataFrame, pairs: Mapping[str, str], expect: str
) -> DataFrame:
    """joined, with values that raise if a match breaks the declared cardinality.

    The check sits in the right side's values, or in the left ones if there are none.
    """
    if expect not in ("m:m", "m:1", "1:1"):
        raise ValueError(f"expect is m:m, m:1 or 1:1, not {expect}")
    if expect == "m:m":
        return joined
    sides = [(right, list(pairs.values()), left, list(pairs))]
    if expect == "1:1":
        sides.append((left, list(pairs), right, list(pairs.values())))
    tests = [_repeated_matches(*x) == 0 for x in sides if not proved_unique(*x[:2])]
    if not tests:
        return joined
    fine = reduce(lambda a, b: a & b, tests)
    fetched = [c for c in right.columns if c not in pairs.values()]
    return _guarded(joined, fetched or left.columns, fine, f"a key of {list(pairs)} occurs more than once")


def _join(
    left: DataFrame, right: DataFrame, on: Keys, expect: str, suffixes: tuple[str, str], nulls: str, how: str
) -> DataFrame:
    pairs = _key_pairs(left, right, on)
    left, right = _add_suffixes(left, right, pairs, suffixes)
    joined = left.join(_right_keys(right, pairs), _same_keys(pairs, nulls), how)
    joined = joined.drop(*[f"{_RIGHT_KEY}{i}" for i in range(len(pairs))])
    return _check_expectation(joined, left, right, pairs, expect)


def join_left(
    left: DataFrame,
    right: DataFrame,
    on: Keys = None,
    expect: str = "m:m",
    suffixes: tuple[str, str] = ("_x", "_y"),
    nulls: str = "match",
) -> DataFrame:
    """Left join; keys default to all shared names, and a mapping is left to right.

    The left names of the keys survive. Other names that both sides use get a
    suffix. With expect "m:1" or "1:1" fetched values raise when they are read and a
    row of left found a key that occurs more than once; repeated keys that no row
    asks for are fine, and a side whose plan proves its keys unique is not counted. nulls="never" leaves missing keys without a match.
    """
    return _join(left, right, on, expect, suffixes, nulls, "left")


def join_inner(
    left: DataFrame,
    right: DataFrame,
    on: Keys = None,
    expect: str = "m:m",
    suffixes: tuple[str, str] = ("_x", "_y"),
    nulls: str = "match",
) -> DataFrame:
    """The rows of `join_left` that found a match."""
    return _join(left, right, on, expect, suffixes, nulls, "inner")


def rows_without_match(left: DataFrame, right: DataFrame, on: Keys = None) -> DataFrame:
    """The rows of left whose key does not occur on the right."""
    pairs = _key_pairs(left, right, on)
    keys = right.select(*[quoted(r) for r in pairs.values()]).distinct()
    return left.join(_right_keys(keys, pairs), _same_keys(pairs), "left_anti")


def join_full(
    left: DataFrame,
    right: DataFrame,
    on: Keys = None,
    suffixes: tuple[str, str] = ("_x", "_y"),
    one_row_per_key: bool = False,
) -> DataFrame:
    """Full join with the keys merged.

    Written as the left join plus the right rows that no left row uses. Spark can
    neither broadcast a side of a full join nor split its skewed partitions; it can
    do both here, and only the distinct left keys take part in the second half. Each
    side is read twice, though. With `one_row_per_key` a key has at most one row on
    either side, so no partition is skewed, and one plain full join reads each side once.
    """
    pairs = _key_pairs(left, right, on)
    if one_row_per_key:
        left, right = _add_suffixes(left, right, pairs, suffixes)
        joined = left.join(_right_keys(right, pairs), _same_keys(pairs), "full")
        keys = {k: F.coalesce(quoted(k), F.col(f"{_RIGHT_KEY}{i}")) for i, k in enumerate(pairs)}
        return joined.withColumns(keys).drop(*[f"{_RIGHT_KEY}{i}" for i in range(len(pairs))])
    unused = rows_without_match(right, left, {r: k for k, r in pairs.items()})
    _, unused = _add_suffixes(left, unused, pairs, suffixes)
    unused = rename(unused, {r: k for k, r in pairs.items()})
    return join_left(left, right, on, "m:m", suffixes).unionByName(unused, allowMissingColumns=True)


def join_checked(
    left: DataFrame,
    right: DataFrame,
    on: Keys = None,
    suffixes: tuple[str, str] = ("_x", "_y"),
    may_be_missing: Sequence[str] = (),
    guarded: Sequence[str] = (),
) -> DataFrame:
    """Left join in which every left row must find exactly one right row.

    Each fetched value raises when its row has no match, when a row found a repeated key,
    and, unless the column is named in `may_be_missing`, when the value is missing. The
    check sits in the values, since Spark prunes one that nobody reads; columns of left
    named in `guarded` carry it as well, for callers that compute with those. Where right's plan
    proves its keys unique (see `proved_unique`), each side is read once; else the key columns
    are read again to be counted.
    """
    pairs = _key_pairs(left, right, on)
    left, right = _add_suffixes(left, right, pairs, suffixes)
    require(left, guarded)
    fetched = [c for c in right.columns if c not in pairs.values()]
    if not fetched:
        raise ValueError("the right side has no column besides its keys")
    proved = proved_unique(right, list(pairs.values()))
    repeated = F.lit(0) if proved else _repeated_matches(right, list(pairs.values()), left, list(pairs))
    marked = _right_keys(right, pairs).withColumn(_MATCHED, F.lit(True))
    joined = left.join(marked, _same_keys(pairs), "left")
    matched = F.col(_MATCHED).isNotNull()
    known = {c: ~missing_test(right, c) for c in fetched if c not in may_be_missing}
    fine = {c: matched & known[c] if c in known else matched for c in fetched}
    fine |= dict.fromkeys(guarded, reduce(lambda a, b: a & b, known.values(), matched))
    again = F.raise_error(F.lit(f"a key of {list(pairs)} occurs more than once"))
    lost = F.raise_error(F.lit(f"no match, or no value, for {fetched} on {list(pairs)}"))
    guards = {}
    for c, test in fine.items():
        kind = joined.schema[c].dataType
        guards[c] = F.when(repeated > 0, again.cast(kind)).when(test, quoted(c)).otherwise(lost.cast(kind))
    drops = [f"{_RIGHT_KEY}{i}" for i in range(len(pairs))]
    return joined.withColumns(guards).drop(_MATCHED, *drops)


def unmatched_keys(left: DataFrame, right: DataFrame, on: Keys = None) -> DataFrame:
    """Keys that occur on one side only, with their row counts.

    The keys of both sides are stacked and counted by side, in one aggregation that
    shrinks every key, however hot, before it is shuffled.
    """
    pairs = _key_pairs(left, right, on)
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    keys = left.select(*[quoted(k) for k in pairs], one.alias("__left"), none.alias("__right"))
    others = right.select(*[quoted(r).alias(k) for k, r in pairs.items()], none.alias("__left"), one.alias("__right"))
    counts = keys.unionByName(others).groupBy(*map(quoted, pairs)).agg(F.sum("__left").alias("__left"), F.sum("__right").alias("__right"))
    single = counts.where((F.col("__left") == 0) | (F.col("__right") == 0))
    side = F.when(F.col("__left") > 0, F.lit("left")).otherwise(F.lit("right"))
    return single.select(*map(quoted, pairs), (F.col("__left") + F.col("__right")).alias("n_rows"), side.alias("side"))
