"""The composite operators on the test tables.

Nations stand for countries and regions for their parents; order value per nation is
the capacity, part types are minerals, return flags are systems, line statuses are
sources and ship years are years.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
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
from tonnage.functions import factor, if_else, is_in, not_in, r_divide, recode
from tonnage.operators import (
    add_sketches,
    add_sums,
    across,
    allocate,
    apply_coefficients,
    blend,
    cap_and_hold,
    compare_sources,
    convert,
    convert_each,
    convert_to,
    derive_units,
    discard,
    fit_line,
    interpolate,
    join_left,
    keep,
    loglog_project,
    loglog_sums,
    median_scalar,
    per_capita,
    price,
    ratio_to,
    recode_and_sum,
    quantile_sketches,
    rename,
    residual,
    rollup_sum,
    scale_by,
    share_of_total,
    sketched_quantile,
    source_differences,
    split_by_fractions,
    split_by_percent,
    split_by_share,
    sum_components,
    tidy_measures,
    weighted_rollup,
)
from tonnage.operators.sketches import RANK_ERROR
from tonnage.sources import stage

# Reshaping and shares

WIDE_SQL = """
SELECT n_name AS nation, n_regionkey,
       CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price,
       CAST(SUM(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) AS discount,
       CAST(SUM(CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) AS tax
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
GROUP BY ALL"""


@query(f"""
WITH wide AS ({WIDE_SQL}),
long AS (
  SELECT nation, n_regionkey, 'quantity' AS measure, quantity AS value FROM wide
  UNION ALL SELECT nation, n_regionkey, 'price', price FROM wide
  UNION ALL SELECT nation, n_regionkey, 'discount', discount FROM wide
  UNION ALL SELECT nation, n_regionkey, 'tax', tax FROM wide)
SELECT nation, measure, value, r_name AS region
FROM long JOIN region ON n_regionkey = r_regionkey
WHERE nation <> 'NATION_24' AND NOT (nation = 'NATION_20' AND measure = 'tax')
  AND NOT (n_regionkey = 1 AND measure = 'price')
""", name="tidy_measures")
def tidy_line_measures(t: Tables) -> DataFrame:
    """A wide text table with a total row, a dash for a missing number, and grouping commas.

    The commas make a number unreadable; only a file's reader takes them out.
    """
    measures = {
        "quantity": "l_quantity",
        "price": "l_extendedprice",
        "discount": "l_discount",
        "tax": "l_tax",
    }
    cents = {k: F.sum(F.col(c).cast("decimal(18,2)")).alias(k) for k, c in measures.items()}
    per_supplier = t.lineitem.groupBy("l_suppkey").agg(*cents.values())
    per_nation = (
        per_supplier.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("s_nationkey")
        .agg(*[F.sum(k).alias(k) for k in measures])
    )
    grouped = F.format_number(F.col("price").cast("double") + 1000, 2)
    wide = per_nation.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("nation"),
        *[F.format_string("%.2f", F.col(k).cast("double")).alias(k) for k in measures],
        grouped.alias("grouped"),
        "n_regionkey",
    )
    price = F.when(F.col("n_regionkey") == 1, F.col("grouped")).otherwise(F.col("price"))
    wide = wide.withColumn("price", price).drop("grouped", "n_regionkey")
    dash = F.when(F.col("nation") == "NATION_20", F.lit("-")).otherwise(F.col("tax"))
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("nation"), F.col("r_name").alias("region")
    )
    return tidy_measures(
        wide.withColumn("tax", dash), list(measures), "measure", places, {"nation": "NATION_24"}
    )


@query(f"""
WITH sales AS ({order_totals_sql("region", "nation")})
SELECT region, nation, sales, round(sales / SUM(sales) OVER (PARTITION BY region), 8) AS share
FROM sales
""", name="share_of_total")
def share_of_region(t: Tables) -> DataFrame:
    sales = stage(order_totals(t, "region", "nation"))
    return rounded(share_of_total(sales, ["region"], "sales"), 8, "share")


@query("""
SELECT o_orderkey, o_orderpriority,
       round(1e6 * o_totalprice / CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2)))
             OVER (PARTITION BY o_orderpriority) AS DOUBLE), 6) AS ppm
FROM orders
""", name="share_of_total_rows")
def share_of_priority(t: Tables) -> DataFrame:
    """Row-level shares of a few very large groups."""
    orders = t.orders.select(
        "o_orderkey", "o_orderpriority", F.col("o_totalprice").cast("decimal(18,2)").alias("price")
    )
    rows = share_of_total(orders, ["o_orderpriority"], "price")
    return rows.select(
        "o_orderkey", "o_orderpriority", F.round(1e6 * F.col("share"), 6).alias("ppm")
    )


TYPE_SHARES = f"""
SELECT region, type, value / SUM(value) OVER (PARTITION BY region) AS share
FROM ({line_totals_sql("region", "type")})"""


@query(f"""
WITH sales AS (SELECT * FROM ({order_totals_sql("region", "nation")}) WHERE region < 4),
shares AS (SELECT * FROM ({TYPE_SHARES}) WHERE region > 0)
SELECT coalesce(sales.region, shares.region) AS region, nation, type,
       round(sales * share, 2) AS sales
FROM sales FULL JOIN shares ON sales.region = shares.region
""", name="split_by_share")
def split_by_type_share(t: Tables) -> DataFrame:
    sales = stage(order_totals(t, "region", "nation").where(F.col("region") < 4))
    totals = stage(line_totals(t, "region", "type").where(F.col("region") > 0))
    shares = discard(share_of_total(totals, ["region"], "value"), "value")
    return rounded(split_by_share(sales, shares, ["region"], "sales"), 2, "sales")


@query(f"""
WITH sales AS ({order_totals_sql("region", "nation")}),
rates AS (SELECT *, CASE WHEN region <> 3 THEN region * 7.5 ELSE 0 END * 0.01 AS p FROM sales)
SELECT region, nation, 'low' AS part, round(sales * 0.63, 2) AS sales FROM rates
UNION ALL SELECT region, nation, 'cable', round(sales * (1 - 0.63::DOUBLE) * p, 2) FROM rates
UNION ALL SELECT region, nation, 'overhead', round(sales * (1 - 0.63::DOUBLE) * (1 - p), 2) FROM rates
""", name="split_by_fractions")
def split_by_fixed_fraction(t: Tables) -> DataFrame:
    key = F.col("r_regionkey")
    rates = t.region.select(key.alias("region"), F.when(key != 3, key * 7.5).alias("percent"))
    rows = split_by_fractions(
        order_totals(t, "region", "nation"),
        "sales",
        ("low", 0.63),
        ("cable", "overhead"),
        rates,
        ["region"],
        "percent",
        "part",
    )
    return rounded(rows, 2, "sales")


@query(f"""
WITH amounts AS (
  SELECT n.n_nationkey AS nation, f.flag, l.value
  FROM nation n CROSS JOIN (VALUES ('A'), ('N'), ('R')) f(flag)
  LEFT JOIN ({line_totals_sql("nation", "flag", measure="l_quantity")}) l
    ON l.nation = n.n_nationkey AND l.flag = f.flag
  WHERE n.n_nationkey IN (SELECT s_nationkey FROM supplier JOIN lineitem ON l_suppkey = s_suppkey)),
percents AS (
  SELECT *, CASE flag WHEN 'A' THEN nation * 1.5 WHEN 'N' THEN nation * 2.5 ELSE nation * 4.0 END AS p
  FROM amounts)
SELECT nation, flag || ' overhead' AS part, round(value * (1 - p / 100), 4) AS value FROM percents
UNION ALL SELECT nation, flag || ' underground', round(value * (p / 100), 4) FROM percents
""", name="split_by_percent")
def split_by_class_percent(t: Tables) -> DataFrame:
    key = F.col("n_nationkey")
    percents = t.nation.select(
        key.alias("nation"),
        (key * 1.5).alias("pct_a"),
        (key * 2.5).alias("pct_n"),
        (key * 4.0).alias("pct_r"),
    )
    classes = {f: (f"pct_{f.lower()}", f"{f} overhead", f"{f} underground") for f in "ANR"}
    amounts = line_totals(t, "nation", "flag", measure="l_quantity")
    rows = split_by_percent(amounts, ["nation"], classes, "flag", "value", percents, "part")
    return rounded(rows, 4, "value")


def nation_capacity(t: Tables) -> DataFrame:
    """Sales by region and nation, staged since a share reads its input twice."""
    return stage(order_totals(t, "region", "nation"))


# Stocks and coefficients


@query("""
SELECT p_type AS type, CAST(SUM(p_size) AS BIGINT) AS size
FROM part WHERE p_brand <> 'Brand#7' GROUP BY ALL
""", name="sum_components")
def sum_brand_components(t: Tables) -> DataFrame:
    parts = t.part.select(
        F.col("p_type").alias("type"),
        F.nullif("p_brand", F.lit("Brand#7")).alias("brand"),
        F.col("p_size").alias("size"),
    )
    return sum_components(parts, ["type"], "size", "brand")


RATES = """
SELECT p_type AS type, p_brand AS mineral,
       CAST(SUM(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS rate
FROM part WHERE p_type <> 'PROMO' GROUP BY ALL"""


def brand_rates(t: Tables) -> DataFrame:
    """Average price per type and brand: a coefficient per brand, and no known one for a type."""
    totals = t.part.groupBy(F.col("p_type").alias("type"), F.col("p_brand").alias("mineral")).agg(
        F.sum(F.col("p_retailprice").cast("decimal(18,2)")).alias("total"),
        F.count(F.lit(1)).alias("n"),
    )
    rate = F.when(F.col("type") != "PROMO", r_divide("total", "n"))
    return totals.select("type", "mineral", rate.alias("rate"))


@query(f"""
WITH stock AS ({line_totals_sql("nation", "type", measure="l_quantity")}), rates AS ({RATES})
SELECT nation, stock.type, mineral, 'tons' AS unit, round(value * rate, 6) AS value
FROM stock JOIN rates ON stock.type = rates.type
""", name="apply_coefficients")
def apply_type_coefficients(t: Tables) -> DataFrame:
    stock = line_totals(t, "nation", "type", measure="l_quantity")
    rows = apply_coefficients(stock, brand_rates(t), ["type"], "value", "rate", "tons")
    return rounded(discard(rows, "rate"), 6, "value")


@query(f"""
WITH km AS ({line_totals_sql("region", "flag", measure="l_quantity")}),
rates AS (
  SELECT l_returnflag AS flag, l_linestatus AS unit,
         CAST(SUM(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS rate
  FROM lineitem GROUP BY ALL)
SELECT region, CASE km.flag WHEN 'A' THEN 'HV' WHEN 'N' THEN 'MV' WHEN 'R' THEN 'LV' END || ' ' || unit
         AS component,
       round(rate * value, 4) AS value
FROM km JOIN rates ON km.flag = rates.flag
""", name="derive_units")
def derive_unit_counts(t: Tables) -> DataFrame:
    lines = stage(
        line_totals(
            t, "region", "flag", "status", measure="l_quantity", discount="l_discount", n=F.lit(1)
        )
    )
    km = lines.groupBy("region", "flag").agg(F.sum("value").alias("value"))
    rates = (
        lines.groupBy("flag", F.col("status").alias("unit"))
        .agg(F.sum("discount").alias("discount"), F.sum("n").alias("n"))
        .select("flag", "unit", r_divide("discount", "n").alias("rate"))
    )
    classes = {"A": "HV", "N": "MV", "R": "LV"}
    rows = derive_units(km, rates, ["flag"], "value", "rate", "flag", classes, "unit", "component")
    return rounded(keep(rows, "region", "component", "value"), 4, "value")


@query(f"""
SELECT nation, CASE WHEN flag = 'A' THEN 'distribution' ELSE 'transmission' END AS flag,
       round(SUM(value), 2) AS value
FROM ({line_totals_sql("nation", "flag")}) GROUP BY ALL
""", name="recode_and_sum")
def recode_flags(t: Tables) -> DataFrame:
    coarse = if_else(F.col("flag") == "A", F.lit("distribution"), F.lit("transmission"))
    rows = recode_and_sum(line_totals(t, "nation", "flag"), "flag", coarse, ["nation", "flag"], "value")
    return rounded(rows, 2, "value")


@query(f"""
WITH stock AS ({line_totals_sql("nation", "type")}),
capacity AS (SELECT * FROM ({order_totals_sql("nation")}) WHERE nation <> 7)
SELECT nation, type, 't/GW' AS unit, round(value / sales, 8) AS value
FROM stock JOIN capacity USING (nation)
""", name="ratio_to")
def ratio_to_capacity(t: Tables) -> DataFrame:
    capacity = order_totals(t, "nation").where(F.col("nation") != 7)
    rows = ratio_to(line_totals(t, "nation", "type"), capacity, ["nation"], "value", "sales", "t/GW")
    return rounded(discard(rows, "sales"), 8, "value")


@query(f"""
WITH stock AS ({line_totals_sql("nation", "type")}),
capacity AS ({order_totals_sql("nation")})
SELECT type, round(SUM(value / (CASE WHEN nation = 7 THEN 0 ELSE sales END * 1000)), 8) AS value
FROM stock JOIN capacity USING (nation) WHERE nation <> 7 GROUP BY ALL
UNION ALL
SELECT type || ' without capacity', '+inf'::DOUBLE FROM stock JOIN capacity USING (nation)
WHERE nation = 7 AND value > 0
""")
def ratio_to_own_capacity(t: Tables) -> DataFrame:
    """The unit-scaled variant, with a capacity of zero for one nation."""
    capacity = order_totals(t, "nation").withColumn(
        "sales", F.when(F.col("nation") == 7, 0.0).otherwise(F.col("sales"))
    )
    rows = ratio_to(
        line_totals(t, "nation", "type"), capacity, ["nation"], "value", "sales", "kg/kW",
        scale=1000.0, complete=False,
    )
    kind = F.when(F.col("nation") == 7, F.concat("type", F.lit(" without capacity")))
    rows = rows.where(F.col("sales").isNotNull()).withColumn("type", F.coalesce(kind, "type"))
    return rounded(rollup_sum([keep(rows, "type", "value")], [["type"]], "value"), 8, "value")


@query(f"""
WITH parts AS ({line_totals_sql("nation", "flag", "status")})
SELECT nation, round(SUM(value), 2) AS value FROM parts GROUP BY ALL
""", name="rollup_sum")
def roll_up_parts(t: Tables) -> DataFrame:
    """Two parts of all lines, read once: those of one status, and those of any other or none."""
    parts = stage(line_totals(t, "nation", "flag", "status"))
    halves = [parts.where(is_in("status", ["F"])), parts.where(not_in("status", ["F"]))]
    return rounded(rollup_sum(halves, [["nation", "flag"], ["nation"]], "value"), 2, "value")


@query(f"""
WITH capacity AS ({order_totals_sql("region", "nation")}),
shares AS (SELECT region, nation, sales / SUM(sales) OVER (PARTITION BY region) AS share FROM capacity),
totals AS ({line_totals_sql("region", "type")})
SELECT shares.region, nation, type, round(value * share, 2) AS value
FROM shares LEFT JOIN totals ON shares.region = totals.region
""", name="allocate")
def allocate_to_nations(t: Tables) -> DataFrame:
    shares = discard(share_of_total(nation_capacity(t), ["region"], "sales"), "sales")
    rows = allocate(line_totals(t, "region", "type"), shares, ["region"], "value")
    return rounded(discard(rows, "share"), 2, "value")


INTENSITY_SQL = f"""
SELECT nation, type, status, value / sales AS value
FROM ({line_totals_sql("nation", "type", "status")}) JOIN ({order_totals_sql("nation")}) USING (nation)"""


REGION_INTENSITY_SQL = f"""
SELECT region, type, status, SUM(value * share) AS value
FROM ({INTENSITY_SQL}) JOIN (
  SELECT region, nation, sales / SUM(sales) OVER (PARTITION BY region) AS share
  FROM ({order_totals_sql("region", "nation")})) USING (nation)
GROUP BY ALL"""


def intensity_by_region(t: Tables) -> DataFrame:
    capacity = nation_capacity(t)
    stock = line_totals(t, "nation", "type", "status")
    intensity = ratio_to(stock, keep(capacity, "nation", "sales"), ["nation"], "value", "sales", "t/GW")
    shares = discard(share_of_total(capacity, ["region"], "sales"), "sales")
    return weighted_rollup(
        keep(intensity, "nation", "type", "status", "value"),
        shares,
        ["nation"],
        ["region", "type", "status"],
        "value",
    )


@query(f"SELECT region, type, status, round(value, 8) AS value FROM ({REGION_INTENSITY_SQL})", name="weighted_rollup")
def weighted_region_intensity(t: Tables) -> DataFrame:
    return rounded(intensity_by_region(t), 8, "value")


@query(f"""
SELECT region, type, round(MAX(value) FILTER (status = 'F'), 8) AS "F",
       round(MAX(value) FILTER (status = 'O'), 8) AS "O"
FROM ({REGION_INTENSITY_SQL}) GROUP BY ALL
""", name="compare_sources")
def compare_statuses(t: Tables) -> DataFrame:
    rows = compare_sources(intensity_by_region(t), "status", ["F", "O"], "value")
    return rounded(rows, 8, "F", "O")


@query(f"""
WITH v AS ({line_totals_sql("region", "type", "flag")}),
sources AS (SELECT DISTINCT flag FROM v), ids AS (SELECT DISTINCT region, type FROM v)
SELECT ids.region, ids.type, a.flag AS source_a, b.flag AS source_b, x.value AS value_a, y.value AS value_b,
       round(y.value - x.value, 2) AS difference, round(y.value / x.value, 8) AS ratio
FROM ids CROSS JOIN sources a JOIN sources b ON a.flag < b.flag
LEFT JOIN v x ON (x.region, x.type, x.flag) = (ids.region, ids.type, a.flag)
LEFT JOIN v y ON (y.region, y.type, y.flag) = (ids.region, ids.type, b.flag)
""", name="source_differences")
def flag_differences(t: Tables) -> DataFrame:
    rows = source_differences(stage(line_totals(t, "region", "type", "flag")), "flag", "value")
    return rounded(rounded(rows, 2, "difference"), 8, "ratio")


@query(f"""
SELECT region, type, round(AVG(value), 8) AS value, 2015 AS year
FROM ({REGION_INTENSITY_SQL}) WHERE NOT (status = 'O' AND type = 'PROMO') GROUP BY ALL
""", name="blend")
def blend_statuses(t: Tables) -> DataFrame:
    exclude = {"status": "O", "type": "PROMO"}
    rows = blend(intensity_by_region(t), exclude, ["region", "type"], "value", 2015)
    return rounded(rows, 8, "value")


@query(f"""
SELECT nation, flag, round(value * 0.001 * 1e-6 / 8760 / (3.6e-3 * 1e-9), 6) AS value, 'Mt/EJ' AS unit
FROM ({line_totals_sql("nation", "flag", measure="l_quantity")})
""")
def unit_chain(t: Tables) -> DataFrame:
    per_year = [("/", factor("kW", "kWh/year"))]
    per_ej = [("/", factor("kWh", "GJ")), ("/", factor("GJ", "EJ"))]
    mass = [("*", factor("kg", "t")), ("*", factor("t", "Mt"))]
    stock = line_totals(t, "nation", "flag", measure="l_quantity")
    return rounded(convert(stock, "value", [*mass, *per_year, *per_ej], unit="Mt/EJ"), 6, "value")


@query(f"""
SELECT nation, flag, CASE flag WHEN 'A' THEN 'kg' WHEN 'R' THEN 'kg' ELSE 'lb' END AS unit,
       round(CASE flag WHEN 'A' THEN value * 1000 WHEN 'R' THEN value * 1e9 END, 2) AS value
FROM ({line_totals_sql("nation", "flag", measure="l_quantity")})
""")
def unit_per_row(t: Tables) -> DataFrame:
    """Tonnes and millions of tonnes to kilograms, row by row, and a unit without a factor."""
    unit = recode("flag", {"A": "t", "N": "lb", "R": "Mt"})
    stock = line_totals(t, "nation", "flag", measure="l_quantity").withColumn("unit", unit)
    factors = {"t": ("kg", factor("t", "kg")), "Mt": ("kg", factor("Mt", "t") * factor("t", "kg"))}
    return rounded(convert_each(stock, "value", factors), 2, "value")


@query(f"""
SELECT nation, flag, CASE WHEN nation % 7 <> 6 THEN 'Mt/EJ' END AS unit,
       round(CASE WHEN nation % 7 = 6 THEN NULL
             WHEN flag = 'A' THEN value * 1e-9 / 3.6e-12 WHEN flag = 'R' THEN value * 1e-6 / 1e-12
             ELSE value * 1e-6 * (908 / 1000.0::DOUBLE) / 1.0551e-12 END / 1e6, 2) AS value
FROM ({line_totals_sql("nation", "flag", measure="l_quantity")})
""")
def unit_paths(t: Tables) -> DataFrame:
    """Amounts per energy in a unit of each row's own, some in none, over several steps above and below the stroke."""
    units = {"A": "kg/kWh", "N": "short t/kBtu", "R": "t/MJ"}
    unit = F.when(F.col("nation") % 7 != 6, recode("flag", units))
    stock = line_totals(t, "nation", "flag", measure="l_quantity").withColumn("unit", unit)
    rows = convert_to(stock, "value", "Mt/EJ", also=list(units.values()))
    return rounded(rows.withColumn("value", F.col("value") / 1e6), 2, "value")


# Projection

PER_HEAD_SQL = f"""
SELECT region, sales / heads / 100000 AS per_head
FROM ({order_totals_sql("region", "year")}) JOIN (
  SELECT n_regionkey AS region, COUNT(*) AS heads
  FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL) USING (region)
WHERE year = 1998"""


def sales_per_head(t: Tables) -> DataFrame:
    """Sales of 1998 per customer, in units of 100,000."""
    customers = (
        t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("heads"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_regionkey").alias("region"))
        .agg(F.sum("heads").alias("heads"))
    )
    rows = per_capita(
        order_totals(t, "region", "year", "priority"),
        across(customers, "year", range(1995, 2002)),
        ["region", "year"],
        ["region", "year"],
        "sales",
        "heads",
        1e-5,
        F.col("year") == 1998,
        ["region", "sales"],
    )
    return rename(rows, {"sales": "per_head"})


@query(f"SELECT region, round(per_head, 8) AS per_head FROM ({PER_HEAD_SQL})", name="per_capita")
def sales_per_customer(t: Tables) -> DataFrame:
    return rounded(sales_per_head(t), 8, "per_head")


PAIRS = {"ECONOMY": (-1.3, -0.41), "LARGE": (-1.5, -0.32), "PROMO": (-1.9, -0.47)}

PROJECTED_SQL = "\nUNION ALL\n".join(
    f"SELECT region, '{k}' AS type, exp({a} + {b} * ln(per_head)) AS value FROM ({PER_HEAD_SQL})"
    for k, (a, b) in PAIRS.items()
)


def projected_by_type(t: Tables) -> DataFrame:
    rows = loglog_project(sales_per_head(t), "per_head", PAIRS, "type", "value")
    return keep(rows, "region", "type", "value")


@query(f"SELECT region, type, round(value, 8) AS value FROM ({PROJECTED_SQL})", name="loglog_project")
def loglog_projection(t: Tables) -> DataFrame:
    return rounded(projected_by_type(t), 8, "value")


FIT_SQL = """
SELECT p_type AS type, l_returnflag AS flag,
       regr_slope(ln(l_extendedprice), ln(l_quantity - 1)) FILTER (l_quantity > 1) AS b,
       regr_intercept(ln(l_extendedprice), ln(l_quantity - 1)) FILTER (l_quantity > 1) AS a,
       regr_r2(ln(l_extendedprice), ln(l_quantity - 1)) FILTER (l_quantity > 1) AS r2,
       COUNT(*) FILTER (l_quantity > 1) AS n, COUNT(*) FILTER (l_quantity <= 1) AS n_left_out
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL"""


def price_of_quantity(t: Tables) -> DataFrame:
    """Sums for the line of log price on log quantity by type and flag, added up from years.

    Quantities of 1 become 0, which has no logarithm.
    """
    kinds = keep(t.part, "p_partkey", "p_type")
    lines = keep(t.lineitem, "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate")
    lines = lines.join(kinds, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_type").alias("type"), F.col("l_returnflag").alias("flag"), F.year("l_shipdate").alias("year"),
        (F.col("l_quantity") - 1).alias("amount"), F.col("l_extendedprice").alias("paid"),
    )
    by_year = loglog_sums(lines, ["type", "flag", "year"], "amount", "paid")
    return add_sums(by_year, ["type", "flag"])


@query(f"SELECT type, flag, round(a, 6) AS a, round(b, 6) AS b, round(r2, 6) AS r2, n, n_left_out FROM ({FIT_SQL})")
def loglog_fit(t: Tables) -> DataFrame:
    return rounded(fit_line(price_of_quantity(t), ["type", "flag"]), 6, "a", "b", "r2")


@query(f"""
SELECT p_partkey AS part, flag, round(exp(a + b * ln(p_size)), 4) AS price
FROM part JOIN ({FIT_SQL}) ON p_type = type
""")
def loglog_fit_project(t: Tables) -> DataFrame:
    """Fitted coefficients, a table, applied to the rows of their type."""
    fitted = stage(fit_line(price_of_quantity(t), ["type", "flag"]))
    parts = t.part.select(F.col("p_partkey").alias("part"), F.col("p_type").alias("type"), F.col("p_size").alias("size"))
    rows = loglog_project(parts, "size", fitted, "flag", "price", on=["type"])
    return rounded(keep(rows, "part", "flag", "price"), 4, "price")


BASE_SQL = f"""
SELECT region, type, CASE WHEN region = 2 AND type = 'PROMO' THEN NULL
       WHEN region = 3 AND type = 'LARGE' THEN 'nan'::DOUBLE ELSE share END AS base
FROM ({TYPE_SHARES})"""

CAPPED_SQL = f"""
WITH rows AS (
  SELECT region, type, base, CASE WHEN isnan(base) OR isnan(value) THEN NULL
         WHEN base < value THEN base WHEN base >= value THEN value END AS capped
  FROM ({PROJECTED_SQL}) LEFT JOIN ({BASE_SQL}) USING (region, type))
SELECT region, type, 2015 AS year, base AS value FROM rows
UNION ALL SELECT region, type, 2050, capped FROM rows
UNION ALL SELECT region, type, 2100, capped FROM rows"""


def capped_by_type(t: Tables) -> DataFrame:
    totals = stage(line_totals(t, "region", "type"))
    shares = share_of_total(totals, ["region"], "value")
    known = ~((F.col("region") == 2) & (F.col("type") == "PROMO"))
    nan = (F.col("region") == 3) & (F.col("type") == "LARGE")
    value = F.when(nan, F.lit(float("nan"))).otherwise(F.col("share"))
    base = shares.select("region", "type", F.when(known, value).alias("base"))
    return cap_and_hold(
        projected_by_type(t), base, ["region", "type"], "value", "base", (2015, 2050, 2100)
    )


@query(f"SELECT region, type, year, round(value, 8) AS value FROM ({CAPPED_SQL})", name="cap_and_hold")
def capped_projection(t: Tables) -> DataFrame:
    return rounded(capped_by_type(t), 8, "value")


@query(f"""
WITH knots AS (
  SELECT nation, type, year, value,
         lead(year) OVER w AS next_year, lead(value) OVER w AS next_value,
         COUNT(*) OVER (PARTITION BY nation, type) AS n
  FROM ({line_totals_sql("nation", "type", "year")}) WHERE year NOT IN (1996, 1999)
  WINDOW w AS (PARTITION BY nation, type ORDER BY year)),
grid AS (
  SELECT nation, type, CAST(y AS INTEGER) AS year
  FROM (SELECT DISTINCT nation, type FROM knots), (SELECT unnest(range(1994, 2003)) AS y))
SELECT grid.nation, grid.type, grid.year,
       round(CASE WHEN n < 2 THEN NULL WHEN grid.year = knots.year THEN value
             ELSE value + (next_value - value) * ((grid.year - knots.year) / (next_year - knots.year)) END, 4)
         AS value
FROM grid LEFT JOIN knots
  ON grid.nation = knots.nation AND grid.type = knots.type
 AND grid.year >= knots.year AND (grid.year < next_year OR (next_year IS NULL AND grid.year = knots.year))
""", name="interpolate")
def interpolate_years(t: Tables) -> DataFrame:
    """All years, two of them without a value."""
    value = F.when(not_in("year", [1996, 1999]), F.col("value"))
    known = line_totals(t, "nation", "type", "year").withColumn("value", value)
    rows = interpolate(known, ["nation", "type"], "year", "value", range(1994, 2003))
    return rounded(rows, 4, "value")


@query("""
WITH knots AS (
  SELECT c_nationkey AS nation, floor(c_acctbal) AS x, AVG(c_custkey * 1.0::DOUBLE) AS y
  FROM customer GROUP BY ALL),
spans AS (
  SELECT *, lead(x) OVER w AS next_x, lead(y) OVER w AS next_y, COUNT(*) OVER (PARTITION BY nation) AS n
  FROM knots WINDOW w AS (PARTITION BY nation ORDER BY x)),
grid AS (
  SELECT nation, CAST(g AS DOUBLE) AS x
  FROM (SELECT DISTINCT nation FROM knots), (SELECT unnest(range(-1500, 11000, 500)) AS g))
SELECT grid.nation, grid.x,
       round(CASE WHEN n < 2 THEN NULL WHEN grid.x = spans.x THEN y
             ELSE y + (next_y - y) * ((grid.x - spans.x) / (next_x - spans.x)) END, 6) AS y
FROM grid LEFT JOIN spans ON grid.nation = spans.nation
 AND grid.x >= spans.x AND (grid.x < next_x OR (next_x IS NULL AND grid.x = spans.x))
""")
def interpolate_dense(t: Tables) -> DataFrame:
    """Many knots per group, several at one x, most of them between grid points."""
    known = t.customer.select(
        F.col("c_nationkey").alias("nation"),
        F.floor("c_acctbal").cast("double").alias("x"),
        F.col("c_custkey").cast("double").alias("y"),
    )
    return rounded(interpolate(known, ["nation"], "x", "y", range(-1500, 11000, 500)), 6, "y")


@query("""
WITH knots AS (
  SELECT c_nationkey AS nation, floor(c_acctbal) AS x, AVG(c_custkey * 1.0::DOUBLE) AS y
  FROM customer WHERE c_nationkey <> 24 GROUP BY ALL),
spans AS (
  SELECT *, lead(x) OVER w AS next_x, lead(y) OVER w AS next_y, COUNT(*) OVER (PARTITION BY nation) AS n
  FROM knots WINDOW w AS (PARTITION BY nation ORDER BY x)),
points AS (
  SELECT DISTINCT c_nationkey AS nation, floor(o_totalprice / 40) AS x
  FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT points.nation, points.x,
       round(CASE WHEN n < 2 THEN NULL WHEN points.x = spans.x THEN y
             ELSE y + (next_y - y) * ((points.x - spans.x) / (next_x - spans.x)) END, 6) AS y
FROM points LEFT JOIN spans ON points.nation = spans.nation
 AND points.x >= spans.x AND (points.x < next_x OR (next_x IS NULL AND points.x = spans.x))
""")
def interpolate_own_points(t: Tables) -> DataFrame:
    """Each nation at the order sizes of its customers; one nation without knots."""
    known = t.customer.where(F.col("c_nationkey") != 24).select(
        F.col("c_nationkey").alias("nation"),
        F.floor("c_acctbal").cast("double").alias("x"),
        F.col("c_custkey").cast("double").alias("y"),
    )
    of = t.customer.select("c_custkey", F.col("c_nationkey").alias("nation"))
    sizes = t.orders.join(of, F.col("o_custkey") == F.col("c_custkey"))
    points = sizes.select("nation", F.floor(F.col("o_totalprice") / 40).cast("double").alias("x"))
    return rounded(interpolate(known, ["nation"], "x", "y", points), 6, "y")


@query("""
SELECT o_orderpriority AS priority, COUNT(*) AS n,
       COUNT(*) FILTER (o_orderstatus = 'P') AS n_missing, TRUE AS near
FROM orders GROUP BY ALL
""")
def sketched_medians(t: Tables) -> DataFrame:
    """Medians of orders by priority from sketches of each month, with missing prices left out.

    near tells whether the share of smaller values lies within the stated error of a half.
    """
    price = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    orders = t.orders.select(F.col("o_orderpriority").alias("priority"), F.trunc("o_orderdate", "month").alias("month"), price.alias("price"))
    months = stage(quantile_sketches(orders, ["priority", "month"], "price"))
    medians = sketched_quantile(add_sketches(months, ["priority"]), 0.5, "median", strict=False)
    rows = join_left(orders, keep(medians, "priority", "median"), ["priority"])
    below, equal = F.count_if(F.col("price") < F.col("median")), F.count_if(F.col("price") == F.col("median"))
    known = F.count("price")
    near = (below <= known * (0.5 + RANK_ERROR)) & (below + equal >= known * (0.5 - RANK_ERROR))
    return rows.groupBy("priority").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("price").isNull()).alias("n_missing"), near.alias("near")
    )


# Costs

PRICE_SQL = """
SELECT p_type AS resource, CAST(year(l_shipdate) AS INTEGER) AS year,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE)
         / CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS price
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_type <> 'SMALL' GROUP BY ALL"""


def type_prices(lines: DataFrame) -> DataFrame:
    """Average price per type and year, from staged totals of price and quantity."""
    rows = (
        lines.where(F.col("type") != "SMALL")
        .groupBy(F.col("type").alias("resource"), "year")
        .agg(F.sum("paid").alias("paid"), F.sum("value").alias("value"))
    )
    return rows.select("resource", "year", r_divide("paid", "value").alias("price"))


PRICED_SQL = f"""
SELECT nation, type, s.year, value * price * 0.13 / 1000 AS cost
FROM ({line_totals_sql("nation", "type", "year", measure="l_quantity")}) s
LEFT JOIN ({PRICE_SQL}) p ON type = resource AND s.year = p.year"""


@query(f"SELECT nation, type, year, round(cost, 4) AS cost FROM ({PRICED_SQL})", name="price")
def price_quantities(t: Tables) -> DataFrame:
    lines = stage(
        line_totals(t, "nation", "type", "year", measure="l_quantity", paid="l_extendedprice")
    )
    rows = price(
        discard(lines, "paid"), type_prices(lines), {"type": "resource", "year": "year"},
        "value", "price", 0.13, 1000.0, "cost",
    )
    return rounded(keep(rows, "nation", "type", "year", "cost"), 4, "cost")


SCALAR_SQL = f"""
SELECT nation, year, sales, AVG(sales) OVER (PARTITION BY year) AS avg_sales,
       median(sales) OVER (PARTITION BY year) AS median_sales,
       sales / median(sales) OVER (PARTITION BY year) AS scalar
FROM ({order_totals_sql("nation", "year")})"""


def yearly_sales(t: Tables) -> DataFrame:
    """Sales by nation and year, staged since mean, median and rows each read them."""
    return stage(order_totals(t, "nation", "year"))


@query(f"""
SELECT nation, year, sales, round(avg_sales, 2) AS avg_sales, round(median_sales, 2) AS median_sales,
       round(scalar, 8) AS scalar
FROM ({SCALAR_SQL})
""", name="median_scalar")
def scalar_to_median(t: Tables) -> DataFrame:
    scalars = median_scalar(yearly_sales(t), ["year"], "sales")
    rows = rounded(scalars, 2, "avg_sales", "median_sales")
    return rounded(rows, 8, "scalar")


SCALED_SQL = f"""
SELECT nation, s.year, flag, value / 1000 * scalar AS cost
FROM ({SCALAR_SQL}) s LEFT JOIN ({line_totals_sql("flag", "year")}) b ON s.year = b.year"""


def scaled_costs(t: Tables, sales: DataFrame) -> DataFrame:
    base = convert(line_totals(t, "flag", "year"), "value", [("/", 1000.0)], "cost")
    scalars = keep(median_scalar(sales, ["year"], "sales"), "nation", "year", "scalar")
    rows = scale_by(scalars, keep(base, "flag", "year", "cost"), ["year"], "cost")
    return keep(rows, "nation", "year", "flag", "cost")


@query(f"SELECT nation, year, flag, round(cost, 4) AS cost FROM ({SCALED_SQL})", name="scale_by")
def scale_by_scalar(t: Tables) -> DataFrame:
    return rounded(scaled_costs(t, yearly_sales(t)), 4, "cost")


@query(f"""
SELECT c.nation, c.year, c.flag, round(cost - sales / 10000, 4) AS cost
FROM ({SCALED_SQL}) c JOIN ({order_totals_sql("nation", "year")}) p
  ON c.nation = p.nation AND c.year = p.year
""", name="residual")
def residual_cost(t: Tables) -> DataFrame:
    sales = yearly_sales(t)
    part = convert(sales, "sales", [("/", 10000.0)])
    rows = residual(scaled_costs(t, sales), part, ["nation", "year"], "cost", "sales")
    return rounded(rows, 4, "cost")
