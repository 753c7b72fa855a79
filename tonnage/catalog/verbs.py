"""Table verbs, scalar functions and aggregates on the test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tonnage.catalog.registry import Tables, query
from tonnage.catalog.totals import (
    line_totals,
    line_totals_sql,
    order_totals,
    order_totals_sql,
    rounded,
    to_double,
)
from tonnage.functions import (
    if_else,
    is_in,
    is_missing,
    label,
    not_in,
    parse_grouped,
    piece,
    r_divide,
    r_log,
    recode,
    strict_mean,
    strict_sum,
    to_number,
    zero_if_missing,
)
from tonnage.operators import (
    across,
    bind_rows,
    discard,
    distinct_rows,
    drop_incomplete,
    flag_missing,
    group_median,
    join_checked,
    join_full,
    join_inner,
    join_left,
    keep,
    longer,
    mutate,
    rename,
    repair_hints,
    share_of_total,
    unmatched_keys,
    wider,
    wider_found,
    with_group_mean,
    with_group_median,
    year_table,
)
from tonnage.sources import read_annotated, read_partitions, stage, write_csv, write_partitions
from tonnage.sources.schemas import schema
from tonnage.sources.staging import shared_folder

MONEY = "decimal(18,2)"


def with_missing_balance(customer: DataFrame) -> DataFrame:
    return customer.withColumn("c_acctbal", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")))


# Selection and computed columns


@query("""
SELECT c_custkey AS customer, c_mktsegment AS segment, c_nationkey AS nation
FROM customer
""")
def select_rename(t: Tables) -> DataFrame:
    rows = keep(t.customer, "c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal")
    rows = rename(rows, {"c_custkey": "customer", "c_mktsegment": "segment", "c_nationkey": "nation"})
    return discard(rows, "c_acctbal")


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       round(l_extendedprice * (1 - l_discount), 4) AS net,
       round(l_extendedprice * (1 - l_discount) * (1 + l_tax), 6) AS gross,
       'usd' AS unit
FROM lineitem
""")
def mutate_chain(t: Tables) -> DataFrame:
    rows = mutate(
        t.lineitem,
        net=F.col("l_extendedprice") * (1 - F.col("l_discount")),
        gross=F.col("net") * (1 + F.col("l_tax")),
        unit=F.lit("usd"),
    )
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    return rounded(rounded(keep(rows, *keys, "net", "gross", "unit"), 4, "net"), 6, "gross")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       round(l_extendedprice / l_quantity, 8) AS unit_price,
       round(l_quantity * l_quantity, 2) AS squared
FROM lineitem
""")
def arithmetic(t: Tables) -> DataFrame:
    rows = mutate(
        t.lineitem,
        unit_price=F.round(r_divide("l_extendedprice", "l_quantity"), 8),
        squared=F.round(F.pow("l_quantity", F.lit(2.0)), 2),
    )
    return keep(rows, "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "unit_price", "squared")


# Filters


@query("""
SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '5-LOW')
""")
def filter_basic(t: Tables) -> DataFrame:
    rows = t.orders.where(
        (F.col("o_orderstatus") == "F") & is_in("o_orderpriority", ["1-URGENT", "5-LOW"])
    )
    return keep(rows, "o_orderkey", "o_orderstatus", "o_orderpriority")


@query("""
SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status FROM orders
WHERE o_orderstatus <> 'F'
""")
def filter_not_in_null(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"))
    return rows.where(not_in("status", ["F"]))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_linestatus FROM lineitem
WHERE NOT (l_returnflag = 'R' AND l_linestatus = 'O')
""")
def filter_not_and(t: Tables) -> DataFrame:
    rows = t.lineitem.where(~((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")))
    return keep(rows, "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus")


@query("""
SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN 'present' ELSE 'missing' END AS part
FROM customer
""")
def filter_missing(t: Tables) -> DataFrame:
    rows = flag_missing(with_missing_balance(t.customer), "c_acctbal", "part", "present", "missing")
    return keep(rows, "c_custkey", "part")


@query("""
SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0
""")
def na_omit(t: Tables) -> DataFrame:
    rows = keep(with_missing_balance(t.customer), "c_custkey", "c_acctbal")
    return drop_incomplete(rows)


# Text and numbers


@query("""
SELECT o_orderkey, round(o_totalprice, 2) AS price,
       CASE WHEN o_totalprice < 1000 THEN round(o_totalprice, 2) END AS plain_price,
       TRY_CAST(o_orderpriority AS DOUBLE) AS unreadable,
       CAST(left(o_orderpriority, 1) AS DOUBLE) AS rank,
       CAST(NULL AS DOUBLE) AS suffixed, CAST(NULL AS DOUBLE) AS ungrouped
FROM orders
""")
def numeric_parse(t: Tables) -> DataFrame:
    """Grouping commas count in a file's column only, and there only between groups of three."""
    price = F.format_number("o_totalprice", 2)
    rank = F.left("o_orderpriority", F.lit(1))
    return t.orders.select(
        "o_orderkey",
        parse_grouped(price).alias("price"),
        to_number(price).alias("plain_price"),
        to_number("o_orderpriority").alias("unreadable"),
        to_number(rank).alias("rank"),
        to_number(F.concat(rank, F.lit("d"))).alias("suffixed"),
        parse_grouped(F.concat(rank, F.lit(",5"))).alias("ungrouped"),
    )


@query("""
SELECT p_partkey,
       CASE WHEN p_size > 45 THEN NULL WHEN p_size < 20 THEN 'small' ELSE 'large' END AS band,
       CASE p_type WHEN 'SMALL' THEN 'S' WHEN 'MEDIUM' THEN 'M' WHEN 'LARGE' THEN 'L' END AS code,
       CASE WHEN p_size > 45 THEN 0.0 ELSE CAST(p_size AS DOUBLE) END AS size_or_zero,
       p_size > 45 AS no_size
FROM part
""")
def if_else_case(t: Tables) -> DataFrame:
    size = F.when(F.col("p_size") <= 45, F.col("p_size").cast("double"))
    return t.part.withColumn("size", size).select(
        "p_partkey",
        if_else(F.col("size") < 20, F.lit("small"), F.lit("large")).alias("band"),
        recode("p_type", {"SMALL": "S", "MEDIUM": "M", "LARGE": "L"}).alias("code"),
        zero_if_missing("size").alias("size_or_zero"),
        is_missing("size").alias("no_size"),
    )


@query("""
SELECT p_partkey, coalesce(nullif(p_type, 'LARGE'), 'NA') || ' ' || p_brand AS label FROM part
""")
def label_concat(t: Tables) -> DataFrame:
    kind = F.nullif("p_type", F.lit("LARGE"))
    return t.part.select("p_partkey", label(kind, F.col("p_brand"), sep=" ").alias("label"))


@query("""
SELECT c_custkey, split_part(c_name, '#', 1) AS head, split_part(c_name, '#', 2) AS tail,
       CAST(split_part(c_name, '#', 2) AS DOUBLE) AS number
FROM customer
""")
def split_label(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey",
        piece("c_name", "#", 1).alias("head"),
        piece("c_name", "#", 2).alias("tail"),
        to_number(piece("c_name", "#", 2)).alias("number"),
    )


@query("""
SELECT c_custkey,
       round(CASE WHEN c_acctbal = 0 THEN '-inf'::DOUBLE WHEN c_acctbal < 0 THEN 'nan'::DOUBLE
                  ELSE ln(c_acctbal) END, 8) AS log_balance,
       round(exp(c_acctbal / 10000), 8) AS growth
FROM customer
""")
def log_exp(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey",
        F.round(r_log("c_acctbal"), 8).alias("log_balance"),
        F.round(F.exp(F.col("c_acctbal") / 10000), 8).alias("growth"),
    )


# Joins


@query("""
SELECT n_nationkey, n_name, n_regionkey AS r_regionkey, r_name
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
""")
def natural_left_join(t: Tables) -> DataFrame:
    nation = rename(t.nation, {"n_regionkey": "r_regionkey"})
    return join_left(nation, keep(t.region, "r_regionkey", "r_name"))


@query("""
SELECT o_orderkey, o_custkey, c_nationkey, c_mktsegment
FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_custkey % 3 <> 0
""")
def left_join_keys(t: Tables) -> DataFrame:
    chosen = t.customer.where(F.col("c_custkey") % 3 != 0)
    rows = join_left(t.orders, chosen, {"o_custkey": "c_custkey"})
    return keep(rows, "o_orderkey", "o_custkey", "c_nationkey", "c_mktsegment")


@query("""
WITH c AS (SELECT c_nationkey AS nation,
                  CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
           FROM customer GROUP BY ALL),
     s AS (SELECT s_nationkey AS nation,
                  CAST(SUM(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
           FROM supplier GROUP BY ALL)
SELECT c.nation, c.balance AS balance_customer, s.balance AS balance_supplier
FROM c LEFT JOIN s USING (nation)
""")
def left_join_suffix(t: Tables) -> DataFrame:
    def total(df: DataFrame, prefix: str) -> DataFrame:
        balance = F.sum(F.col(f"{prefix}_acctbal").cast(MONEY)).cast("double")
        nation = F.col(f"{prefix}_nationkey").alias("nation")
        return df.groupBy(nation).agg(balance.alias("balance"))

    return join_left(
        total(t.customer, "c"),
        total(t.supplier, "s"),
        ["nation"],
        expect="1:1",
        suffixes=("_customer", "_supplier"),
    )


@query("""
WITH c AS (SELECT nullif(c_nationkey, 3) AS nation, COUNT(*) AS customers
           FROM customer GROUP BY ALL)
SELECT s_suppkey, nullif(s_nationkey, 3) AS nation, customers
FROM supplier LEFT JOIN c ON nullif(s_nationkey, 3) IS NOT DISTINCT FROM c.nation
""")
def join_null_keys(t: Tables) -> DataFrame:
    nation = F.nullif(F.col("c_nationkey"), F.lit(3)).alias("nation")
    customers = t.customer.groupBy(nation).agg(F.count(F.lit(1)).alias("customers"))
    suppliers = t.supplier.select(
        "s_suppkey", F.nullif(F.col("s_nationkey"), F.lit(3)).alias("nation")
    )
    return join_left(suppliers, customers, ["nation"])


@query("""
WITH c AS (SELECT c_nationkey AS nation, COUNT(*) AS customers FROM customer
           WHERE c_nationkey < 15 GROUP BY ALL),
     s AS (SELECT s_nationkey AS nation, COUNT(*) AS suppliers FROM supplier
           WHERE s_nationkey > 10 GROUP BY ALL)
SELECT coalesce(c.nation, s.nation) AS nation, customers, suppliers
FROM c FULL JOIN s ON c.nation = s.nation
""")
def full_join(t: Tables) -> DataFrame:
    customers = (
        t.customer.where(F.col("c_nationkey") < 15)
        .groupBy(F.col("c_nationkey").alias("nation"))
        .agg(F.count(F.lit(1)).alias("customers"))
    )
    suppliers = (
        t.supplier.where(F.col("s_nationkey") > 10)
        .groupBy(F.col("s_nationkey").alias("nation"))
        .agg(F.count(F.lit(1)).alias("suppliers"))
    )
    return join_full(customers, suppliers, ["nation"], one_row_per_key=True)


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p_brand, p_size
FROM lineitem JOIN part ON l_partkey = p_partkey AND p_size > 10
""")
def join_inner_complete(t: Tables) -> DataFrame:
    """All parts, the smaller ones without a size."""
    size = F.when(F.col("p_size") > 10, F.col("p_size")).alias("p_size")
    parts = t.part.select("p_partkey", "p_brand", size)
    lines = keep(t.lineitem, "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return drop_incomplete(join_inner(lines, parts, {"l_partkey": "p_partkey"}, nulls="never"))


@query(f"""
WITH sales AS ({line_totals_sql("region", "type")})
SELECT n_nationkey AS nation, region, type, share
FROM nation JOIN (
  SELECT region, type, round(value / SUM(value) OVER (PARTITION BY region), 8) AS share FROM sales
) ON n_regionkey = region
""")
def join_m2m(t: Tables) -> DataFrame:
    shares = share_of_total(stage(line_totals(t, "region", "type")), ["region"], "value")
    nation = t.nation.select(F.col("n_nationkey").alias("nation"), F.col("n_regionkey").alias("region"))
    rows = join_inner(nation, discard(shares, "value"), ["region"], expect="m:m")
    return rounded(rows, 8, "share")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_orderpriority, o_totalprice
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""", name="join_checked")
def checked_join(t: Tables) -> DataFrame:
    lines = keep(t.lineitem, "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    orders = keep(t.orders, "o_orderkey", "o_orderpriority", "o_totalprice")
    return join_checked(lines, orders, {"l_orderkey": "o_orderkey"})


@query("""
SELECT o_custkey AS customer, 'left' AS side, COUNT(*) AS n_rows FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 1000) GROUP BY ALL
UNION ALL
SELECT c_custkey, 'right', COUNT(*) FROM customer
WHERE c_acctbal > 1000 AND c_custkey NOT IN (SELECT o_custkey FROM orders) GROUP BY ALL
""", name="unmatched_keys")
def unmatched_key_report(t: Tables) -> DataFrame:
    orders = t.orders.select(F.col("o_custkey").alias("customer"))
    rich = t.customer.where(F.col("c_acctbal") > 1000).select(F.col("c_custkey").alias("customer"))
    return unmatched_keys(orders, rich, ["customer"])


SPOILED_SQL = """
SELECT CASE p_partkey % 6 WHEN 0 THEN upper(p_name) || ' ' WHEN 1 THEN substr(p_name, 2)
  WHEN 2 THEN replace(p_name, 'e', 'é') WHEN 3 THEN replace(p_name, ' ', '--') || 'x'
  WHEN 4 THEN p_name || ' of ' || p_type ELSE p_name END AS key FROM part"""


def _normal_sql(column: str) -> str:
    return f"trim(regexp_replace(lower(strip_accents({column})), '[^a-z0-9]+', ' ', 'g'))"


@query(f"""
WITH theirs AS (SELECT DISTINCT p_name AS hint FROM part),
lost AS (SELECT key, COUNT(*) AS n_rows FROM ({SPOILED_SQL}) WHERE key NOT IN (SELECT hint FROM theirs) GROUP BY key),
near AS (
  SELECT key, hint, CAST(levenshtein({_normal_sql("key")}, {_normal_sql("hint")}) AS INTEGER) AS edits
  FROM lost, theirs),
best AS (
  SELECT key, MIN(hint) AS hint, edits, COUNT(*) AS n_hints FROM near WHERE edits <= 1
  GROUP BY key, edits QUALIFY edits = MIN(edits) OVER (PARTITION BY key))
SELECT key, n_rows, hint, edits, COALESCE(n_hints, 0) AS n_hints FROM lost LEFT JOIN best USING (key)
""", name="repair_hints")
def part_name_hints(t: Tables) -> DataFrame:
    name, place = F.col("p_name"), F.col("p_partkey") % 6
    spoiled = (
        F.when(place == 0, F.concat(F.upper(name), F.lit(" ")))
        .when(place == 1, F.expr("substring(p_name, 2)"))
        .when(place == 2, F.replace(name, F.lit("e"), F.lit("é")))
        .when(place == 3, F.concat(F.replace(name, F.lit(" "), F.lit("--")), F.lit("x")))
        .when(place == 4, F.concat(name, F.lit(" of "), F.col("p_type")))
        .otherwise(name)
    )
    return repair_hints(t.part.select(spoiled.alias("key")), t.part, {"key": "p_name"})


# Grids


@query("""
SELECT n_nationkey AS nation, CAST(y AS INTEGER) AS year
FROM nation, (SELECT unnest(range(1995, 2006)) AS y)
""")
def grid(t: Tables) -> DataFrame:
    nation = t.nation.select(F.col("n_nationkey").alias("nation"))
    return across(nation, "year", range(1995, 2006))


@query("""
SELECT CAST(y AS INTEGER) AS year, COUNT(o_orderkey) AS orders
FROM (SELECT unnest(range(1990, 2006, 5)) AS y) LEFT JOIN orders ON year(o_orderdate) = y
GROUP BY ALL
""")
def year_counts(t: Tables) -> DataFrame:
    counts = t.orders.groupBy(F.year("o_orderdate").alias("year")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    rows = join_left(year_table(t.spark, range(1990, 2006, 5)), counts, ["year"], expect="m:1")
    return rows.withColumn("orders", F.coalesce("orders", F.lit(0)))


# Aggregates

# A few balances become null, so that some groups are complete and some are not.
NULLED = "CASE WHEN c_acctbal > -980 THEN CAST(c_acctbal AS DECIMAL(18,2)) END"


def nulled_balance(t: Tables) -> DataFrame:
    balance = F.when(F.col("c_acctbal") > -980, F.col("c_acctbal").cast(MONEY))
    return t.customer.select("c_nationkey", "c_mktsegment", balance.alias("balance"))


@query(f"""
SELECT c_nationkey, c_mktsegment,
       CAST(CASE WHEN COUNT({NULLED}) = COUNT(*) THEN SUM({NULLED}) END AS DOUBLE) AS total
FROM customer GROUP BY ALL
""", name="strict_sum")
def strict_sums(t: Tables) -> DataFrame:
    groups = nulled_balance(t).groupBy("c_nationkey", "c_mktsegment")
    return to_double(groups.agg(strict_sum("balance").alias("total")), "total")


@query("""
SELECT c_nationkey, c_mktsegment,
       round(CASE WHEN bool_and(c_acctbal > -980) THEN AVG(c_acctbal) END, 6) AS mean
FROM customer GROUP BY ALL
""", name="strict_mean")
def strict_means(t: Tables) -> DataFrame:
    rows = t.customer.select(
        "c_nationkey",
        "c_mktsegment",
        F.when(F.col("c_acctbal") > -980, F.col("c_acctbal")).alias("balance"),
    )
    groups = rows.groupBy("c_nationkey", "c_mktsegment")
    return rounded(groups.agg(strict_mean("balance").alias("mean")), 6, "mean")


@query("""
SELECT DISTINCT l_returnflag AS flag, l_linestatus AS status,
       CAST(year(l_shipdate) AS INTEGER) AS year
FROM lineitem
""", name="distinct_rows")
def distinct_combinations(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("status"),
        F.year("l_shipdate").alias("year"),
    )
    return distinct_rows(rows)


@query("""
SELECT o_orderpriority, round(median(o_totalprice), 4) AS median
FROM orders GROUP BY ALL
""")
def median_by_group(t: Tables) -> DataFrame:
    return rounded(group_median(t.orders, ["o_orderpriority"], "o_totalprice"), 4, "median")


@query(f"""
WITH sales AS ({order_totals_sql("region", "nation", "year")})
SELECT region, nation, year, sales,
       round(AVG(sales) OVER (PARTITION BY year), 2) AS mean,
       round(median(sales) OVER (PARTITION BY year), 2) AS median
FROM sales
""")
def group_mean_median(t: Tables) -> DataFrame:
    sales = stage(order_totals(t, "region", "nation", "year"))
    rows = with_group_mean(sales, ["year"], "sales", "mean")
    rows = with_group_median(rows, ["year"], "sales", "median")
    return rounded(rows, 2, "mean", "median")


# Stacking and reshaping


@query("""
SELECT c_custkey AS id, c_nationkey AS nation, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance
FROM customer
UNION ALL
SELECT s_suppkey, s_nationkey, NULL, s_acctbal FROM supplier
""")
def union_by_name(t: Tables) -> DataFrame:
    customers = t.customer.select(
        F.col("c_custkey").alias("id"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = t.supplier.select(
        F.col("s_acctbal").alias("balance"),
        F.col("s_nationkey").alias("nation"),
        F.col("s_suppkey").alias("id"),
    )
    return bind_rows(customers, suppliers)


LINE_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "\nUNION ALL\n".join(
        f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, '{m}' AS measure, "
        f"nullif({m}, 0) AS value FROM lineitem"
        for m in LINE_MEASURES
    )
)
def unpivot(t: Tables) -> DataFrame:
    rows = keep(t.lineitem, "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *LINE_MEASURES)
    rows = rows.withColumns({m: F.nullif(F.col(m), F.lit(0.0)) for m in LINE_MEASURES})
    return longer(rows, LINE_MEASURES, "measure")


@query("""
SELECT o_orderpriority,
       COUNT(*) FILTER (o_orderstatus = 'F') AS "F",
       COUNT(*) FILTER (o_orderstatus = 'O') AS "O",
       nullif(COUNT(*) FILTER (o_orderstatus = 'X'), 0) AS "X"
FROM orders GROUP BY ALL
""")
def pivot(t: Tables) -> DataFrame:
    counts = t.orders.groupBy("o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return wider(counts, "o_orderstatus", "n", ["F", "O", "X"])


@query(f"""
SELECT nation, MAX(sales) FILTER (status = 'F') AS "F", MAX(sales) FILTER (status = 'O') AS "O",
       MAX(sales) FILTER (status = 'P') AS "P"
FROM ({order_totals_sql("nation", "status")}) GROUP BY nation
""")
def pivot_found(t: Tables) -> DataFrame:
    return wider_found(stage(order_totals(t, "nation", "status")), "status", "sales")


# Files


PARTS_SQL = """
SELECT CAST(p_partkey AS INTEGER) AS key,
       CASE WHEN p_partkey % 5 = 0 THEN '#' ELSE '' END || p_name || ', "' || p_brand || '"' AS name,
       CASE WHEN p_size % 7 <> 0 THEN p_type END AS kind,
       CASE WHEN p_size % 11 <> 0 THEN round(p_retailprice, 2) END AS price
FROM part"""

PARTS = schema("iccn", "key", "name", "kind", "price")
PART_NOTES = ["# parts", '"# sizes, types"']


def annotated_parts(t: Tables) -> DataFrame:
    """Texts with commas, quotes and signs of notes, and missing texts and numbers."""
    name = F.concat(
        F.when(F.col("p_partkey") % 5 == 0, F.lit("#")).otherwise(F.lit("")),
        F.col("p_name"), F.lit(', "'), F.col("p_brand"), F.lit('"'),
    )
    return t.part.select(
        F.col("p_partkey").cast("int").alias("key"),
        name.alias("name"),
        F.when(F.col("p_size") % 7 != 0, F.col("p_type")).alias("kind"),
        F.when(F.col("p_size") % 11 != 0, F.round("p_retailprice", 2)).alias("price"),
    )


def new_folder(t: Tables, kind: str) -> str:
    return f"{shared_folder(t.spark)}/{kind}-{uuid.uuid4().hex}"


@query(PARTS_SQL)
def csv_round_trip(t: Tables) -> DataFrame:
    """A table written as annotated CSV parts to the shared folder, and read back."""
    folder = new_folder(t, "csv")
    write_csv(annotated_parts(t), folder, {"price": "retail price"}, PART_NOTES)
    return read_annotated(t.spark, folder, PARTS, skip=len(PART_NOTES))


@query(PARTS_SQL)
def csv_many_files(t: Tables) -> DataFrame:
    """The same from 48 files, each with notes and a header of its own."""
    folder = new_folder(t, "csv")
    write_csv(annotated_parts(t).repartition(48, "key"), folder, {"price": "retail price"}, PART_NOTES)
    return read_annotated(t.spark, folder, PARTS, skip=len(PART_NOTES))


@query(f"""
SELECT row_number() OVER (ORDER BY price NULLS FIRST, key) AS place, key, price FROM ({PARTS_SQL})
""")
def csv_sorted_parts(t: Tables) -> DataFrame:
    """Parts of CSV sorted as a whole, read back as the one text they make together, with each line's place.

    The lines of a part are numbered in its own task, and the parts by a table of their sizes.
    """
    folder = new_folder(t, "csv")
    write_csv(annotated_parts(t), folder, notes=PART_NOTES, order=["price", "key"], one_head=True)
    lines = t.spark.read.text(folder).select(
        "value", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("id"),
    )
    lines = stage(lines)
    sizes = lines.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    earlier = F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    before = sizes.select("file", F.coalesce(earlier, F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("file").orderBy("start", "id"))
    placed = lines.withColumn("within", within).join(before, "file")
    # The notes and the header come first, whatever the part.
    place = F.col("before") + F.col("within") - (len(PART_NOTES) + 1)
    rows = placed.select(place.alias("place"), "value").where(F.col("place") > 0)
    fields = F.from_csv("value", "key INT, name STRING, kind STRING, price DOUBLE", {"escape": '"', "nullValue": "NA"})
    return rows.select("place", fields.alias("r")).select("place", "r.key", "r.price")


LINE_YEARS_SQL = """
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS flag,
       l_linestatus AS status, CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
FROM lineitem GROUP BY ALL"""


@query(f"""
SELECT year, flag, status, CASE WHEN year >= 1998 AND flag IS DISTINCT FROM 'A' THEN -quantity ELSE quantity END AS quantity
FROM ({LINE_YEARS_SQL})
""")
def parquet_replace_partitions(t: Tables) -> DataFrame:
    """A table kept by year and flag; a second job replaces some combinations as a whole, one with a missing flag."""
    rows = t.lineitem.select(
        F.year("l_shipdate").alias("year"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("flag"),
        F.col("l_linestatus").alias("status"),
        F.col("l_quantity").cast("decimal(18,2)").alias("quantity"),
    )
    rows = stage(rows.groupBy("year", "flag", "status").agg(F.sum("quantity").cast("double").alias("quantity")))
    folder = new_folder(t, "parquet")
    write_partitions(rows, folder, ["year", "flag"])
    later = rows.where((F.col("year") >= 1998) & ~F.col("flag").eqNullSafe("A"))
    write_partitions(later.withColumn("quantity", -F.col("quantity")), folder, ["year", "flag"])
    return read_partitions(t.spark, folder, rows.schema)
