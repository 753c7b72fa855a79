"""Totals of the order and line tables by nation, region, type, flag, status and year.

Money is summed as decimals, so the totals do not depend on the order of the rows.
Orders and lines are reduced to one row per customer or supplier before they meet the
customer or supplier table, which also collapses a customer or supplier that owns a
large part of the rows. Totals by type join the lines, cut to the columns needed, to the
part table first: parts and suppliers of a line hardly repeat together, so a sum before
that join would save nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonnage.catalog.registry import Tables


def money(column: str | Column) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    return F.sum(value.cast("decimal(18,2)"))


def to_double(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


def line_totals(
    t: Tables, *by: str, measure: str = "l_extendedprice", **more: str | Column
) -> DataFrame:
    """Sum of a line measure as `value`, and of further measures under their own names.

    `by` is any of region, nation, type, flag, status, year.
    """
    measures = {"value": measure} | more
    columns = {
        "flag": F.col("l_returnflag"),
        "status": F.col("l_linestatus"),
        "year": F.year("l_shipdate"),
        "type": F.col("p_type"),
    }
    inner = [c for c in by if c in columns]
    own = [columns[c].alias(c) for c in inner]
    sums = [money(c).alias(name) for name, c in measures.items()]
    again = [F.sum(name).alias(name) for name in measures]
    lines = t.lineitem
    if "type" in by:
        lines = lines.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    if not {"region", "nation"} & set(by):
        return to_double(lines.groupBy(*own).agg(*sums), *measures)
    per_supplier = lines.groupBy("l_suppkey", *own).agg(*sums)
    per_nation = (
        per_supplier.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("s_nationkey", *inner)
        .agg(*again)
    )
    placed = per_nation.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    places = {"region": F.col("n_regionkey"), "nation": F.col("n_nationkey")}
    outer = [places.get(c, F.col(c)).alias(c) for c in by]
    return to_double(placed.groupBy(*outer).agg(*again), *measures)


_LINE_SQL = {
    "region": "n_regionkey AS region",
    "nation": "n_nationkey AS nation",
    "type": "p_type AS type",
    "flag": "l_returnflag AS flag",
    "status": "l_linestatus AS status",
    "year": "CAST(year(l_shipdate) AS INTEGER) AS year",
}


def line_totals_sql(*by: str, measure: str = "l_extendedprice") -> str:
    columns = ", ".join(_LINE_SQL[c] for c in by)
    return f"""
SELECT {columns}, CAST(SUM(CAST({measure} AS DECIMAL(18,2))) AS DOUBLE) AS value
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey
GROUP BY ALL"""


def order_totals(t: Tables, *by: str) -> DataFrame:
    """Sum of order prices as `sales`; `by` is any of region, nation, status, priority, year."""
    own = {
        "status": F.col("o_orderstatus"),
        "priority": F.col("o_orderpriority"),
        "year": F.year("o_orderdate"),
    }
    inner = [c for c in by if c in own]
    per_customer = t.orders.groupBy("o_custkey", *[own[c].alias(c) for c in inner]).agg(
        money("o_totalprice").alias("sales")
    )
    per_nation = (
        per_customer.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", *inner)
        .agg(F.sum("sales").alias("sales"))
    )
    placed = per_nation.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    places = {"region": F.col("n_regionkey"), "nation": F.col("n_nationkey")}
    outer = [places.get(c, F.col(c)).alias(c) for c in by]
    return to_double(placed.groupBy(*outer).agg(F.sum("sales").alias("sales")), "sales")


_ORDER_SQL = {
    "region": "n_regionkey AS region",
    "nation": "n_nationkey AS nation",
    "status": "o_orderstatus AS status",
    "priority": "o_orderpriority AS priority",
    "year": "CAST(year(o_orderdate) AS INTEGER) AS year",
}


def order_totals_sql(*by: str) -> str:
    columns = ", ".join(_ORDER_SQL[c] for c in by)
    return f"""
SELECT {columns}, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS sales
FROM orders JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
GROUP BY ALL"""
