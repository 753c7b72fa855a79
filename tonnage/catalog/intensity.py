"""The whole material-intensity plan on inputs that Spark derives from the test tables.

Nations are countries and regions the model regions. Line quantities by supplier
nation make the grid stock and the line lengths, order value by customer nation the
capacity and the generation, customers the population, and parts the intensities
and prices. The inputs carry the awkward cases of real files: a total row, a dash
for missing, line labels that differ by one character, a country with a capacity of
zero and a country whose region has no line lengths. A capacity of zero leaves its
whole region without a coefficient, and the costs of such a region are an error, so
the cost query takes the true capacity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonnage.catalog.registry import Tables, query
from tonnage.catalog.totals import line_totals, order_totals, rounded
from tonnage.functions import r_divide, recode
from tonnage.functions.units import MODEL_YEARS
from tonnage.operators import across, keep
from tonnage.plans import (
    Inputs,
    base_year,
    capacity_total,
    country_intensity,
    intensity_from_regions,
    intensity_from_stock,
    material_coefficients,
    mt_per_ej,
    region_intensity,
    run,
    source_comparison,
)
from tonnage.sources import stage
from tonnage.sources.schemas import STOCK_MEASURES

MINERALS = {
    "ECONOMY": "steel",
    "STANDARD": "steel",
    "LARGE": "aluminium",
    "PROMO": "aluminium",
    "MEDIUM": "copper",
    "SMALL": "copper",
}
COMPONENTS = [
    f"{voltage} {kind}"
    for voltage in ("HV", "MV", "LV")
    for kind in ("overhead", "underground", "transformer", "substation")
]
LINE_TYPES = {
    1: "1-URGENT",
    2: "2-HIGH",
    3: "3-MEDIUM",
    4: "4-NOT SPECIFIED",
    5: "5 LOW",
    11: "<=1 kV",
    12: "Cable 1-100 kV",
    13: "OH 1-100 kV",
}
VOLTAGES = {"A": "High", "N": "Medium", "R": "Low"}
UNITS = {"F": "transformer", "O": "substation"}
SECTOR_OF = {
    "BUILDING": "elect_td_bld",
    "MACHINERY": "elect_td_ind",
    "AUTOMOBILE": "elect_td_trn",
    "FURNITURE": "other",
    "HOUSEHOLD": "other",
}


def _d_region(nation: Column) -> Column:
    return F.when(nation == 24, F.lit("D9")).otherwise(F.concat(F.lit("D"), nation % 7))


def _hierarchy(t: Tables) -> DataFrame:
    return t.nation.select(
        F.col("n_name").alias("country"),
        F.concat(F.lit("K"), "n_regionkey").alias("k_region"),
        _d_region(F.col("n_nationkey")).alias("d_region"),
        (F.col("n_regionkey") + 1).alias("region_id"),
    )


def _stock(t: Tables, lines: DataFrame) -> DataFrame:
    measure = (
        F.when((F.col("flag") == "A") & (F.col("status") == "F"), "transmission")
        .when((F.col("flag") == "A") & (F.col("status") == "O"), "distribution")
        .when((F.col("flag") == "N") & (F.col("status") == "F"), "transmission_transformer")
        .when((F.col("flag") == "N") & (F.col("status") == "O"), "distribution_transformer")
        .otherwise("genstepup_transformer")
    )
    wide = (
        lines.withColumn("measure", measure)
        .join(t.nation, F.col("nation") == F.col("n_nationkey"))
        .groupBy(F.col("n_name").alias("country"))
        .pivot("measure", list(STOCK_MEASURES))
        .agg(F.sum("value"))
    )
    total = wide.groupBy(F.lit("Total").alias("country")).agg(
        *[F.sum(m).alias(m) for m in STOCK_MEASURES]
    )
    unknown = F.col("country") == "NATION_20"
    return wide.unionByName(total).select(
        "country",
        *[F.when(unknown, "-").otherwise(F.col(m).cast("string")).alias(m) for m in STOCK_MEASURES],
    )


def _parts(t: Tables) -> DataFrame:
    """Size of the parts by brand number and mineral, in two halves."""
    return t.part.groupBy(
        F.substring("p_brand", 7, 2).cast("int").alias("brand"),
        recode("p_type", MINERALS).alias("mineral"),
        (F.col("p_size") % 2).alias("odd"),
    ).agg(F.sum("p_size").cast("double").alias("size"))


def _k_intensity(parts: DataFrame) -> DataFrame:
    kind = F.when(F.col("odd") == 1, "pylon").otherwise("conductor")
    line_type = recode("brand", LINE_TYPES)
    rows = parts.select(
        F.when(F.col("brand") <= 10, "transmission").otherwise("distribution").alias("system"),
        F.when(line_type.isNull(), "transformer").otherwise(kind).alias("component"),
        line_type.alias("line_type"),
        "mineral",
        "size",
    )
    unit = F.when(F.col("line_type").isNull(), "t/GVA").otherwise("t/km")
    return (
        rows.groupBy("system", "component", "line_type", "mineral")
        .agg(F.sum("size").alias("intensity"))
        .withColumn("unit", unit)
    )


def _d_intensity(parts: DataFrame) -> DataFrame:
    component = recode(F.col("brand") % 12, dict(enumerate(COMPONENTS)))
    return (
        parts.groupBy(component.alias("component"), "mineral")
        .agg((F.sum("size") * 10).alias("intensity"))
        .withColumn("unit", F.lit("kg/km"))
    )


def _line_length(lines: DataFrame) -> DataFrame:
    return (
        lines.where(F.col("nation") != 24)
        .groupBy(
            _d_region(F.col("nation")).alias("d_region"), recode("flag", VOLTAGES).alias("voltage")
        )
        .agg(F.sum("value").alias("km"))
    )


def _underground(t: Tables) -> DataFrame:
    key = F.substring("d_region", 2, 1).cast("double")
    regions = t.nation.select(_d_region(F.col("n_nationkey")).alias("d_region")).distinct()
    return regions.select(
        "d_region",
        F.lit(0.0).alias("income_pc"),
        (key * 5).alias("pct_hv"),
        (key * 10).alias("pct_mv"),
        F.when(key < 9, key * 12).alias("pct_lv"),
    )


def _equipment(lines: DataFrame) -> DataFrame:
    totals = lines.groupBy("status", "flag").agg(
        F.sum("discount").alias("discount"), F.sum("n").alias("n")
    )
    return totals.select(
        recode("status", UNITS).alias("unit"),
        recode("flag", VOLTAGES).alias("voltage"),
        r_divide("discount", "n").alias("units_per_km"),
    )


def _capacity(sales: DataFrame, zero: bool) -> DataFrame:
    gw = F.col("sales") / 1e6
    return sales.select(
        F.concat(F.lit("NATION_"), "nation").alias("country"),
        F.concat(F.lit("K"), "region").alias("k_region"),
        (F.when(F.col("nation") == 23, 0.0).otherwise(gw) if zero else gw).alias("gw"),
    )


def _generation(t: Tables, sales: DataFrame) -> DataFrame:
    return sales.join(t.region, F.col("region") == F.col("r_regionkey")).select(
        F.lit("EJ").alias("units"),
        recode("status", {"F": "Reference", "O": "Other"}).alias("scenario"),
        F.col("r_name").alias("region"),
        (F.col("year") + 52).alias("year"),
        (F.col("sales") / 1e7).alias("value"),
    )


def _population(t: Tables) -> DataFrame:
    heads = (
        t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("n_regionkey").agg(F.sum("n").cast("double").alias("value"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("r_name").alias("region"), "value")
    )
    return across(across(heads, "scenario", ["Reference", "Other"]), "year", range(2047, 2054))


def _prices(t: Tables) -> DataFrame:
    totals = (
        t.part.groupBy(recode("p_type", MINERALS).alias("mineral"))
        .agg(F.sum(F.col("p_retailprice").cast("decimal(18,2)")).alias("paid"), F.count(F.lit(1)).alias("n"))
        .select("mineral", r_divide("paid", "n").alias("mean"))
    )
    return across(totals, "year", MODEL_YEARS).select(
        "mineral",
        F.lit("usd/kg").alias("price_unit"),
        "year",
        (F.col("mean") / 1000 * (1 + (F.col("year") - 2015) / 1000)).alias("price"),
    )


def _costs(t: Tables) -> DataFrame:
    sector = recode("c_mktsegment", SECTOR_OF)
    totals = t.customer.groupBy(sector.alias("sector")).agg(
        F.sum(F.col("c_acctbal").cast("decimal(18,2)")).alias("balance"), F.count(F.lit(1)).alias("n")
    )
    return across(totals, "year", MODEL_YEARS).select(
        "sector",
        F.col("sector").alias("subsector"),
        F.col("sector").alias("technology"),
        F.lit("non-energy").alias("cost_input"),
        "year",
        (r_divide("balance", "n") / 100).alias("cost"),
    )


def inputs(t: Tables, zero: bool = True) -> Inputs:
    """All input tables; the fact tables are reduced and staged once, then shared.

    With `zero` one nation has a capacity of zero.
    """
    lines = stage(
        line_totals(
            t, "nation", "flag", "status", measure="l_quantity", discount="l_discount", n=F.lit(1)
        )
    )
    sales = stage(order_totals(t, "region", "nation", "status", "year", "priority"))
    parts = stage(_parts(t))
    region = (F.col("r_regionkey") + 1).alias("region_id")
    line_mix = sales.groupBy(
        F.concat(F.lit("K"), "region").alias("k_region"), F.col("priority").alias("line_type")
    ).agg((F.sum("sales") / 1000).alias("km"))
    return Inputs(
        hierarchy=_hierarchy(t),
        regions=t.region.select(region, F.col("r_name").alias("region")),
        stock=_stock(t, lines),
        line_mix=line_mix,
        capacity=_capacity(sales, zero),
        k_intensity=_k_intensity(parts),
        underground=_underground(t),
        line_length=_line_length(lines),
        equipment=_equipment(lines),
        d_intensity=_d_intensity(parts),
        generation=_generation(t, sales),
        population=_population(t),
        prices=_prices(t),
        costs=_costs(t),
    )


def _case(column: str, mapping: dict) -> str:
    whens = " ".join(f"WHEN {k!r} THEN {v!r}" for k, v in mapping.items())
    return f"CASE {column} {whens} END"


COMPONENT_CASE = _case("brand % 12", dict(enumerate(COMPONENTS)))


def inputs_sql(zero: bool = True) -> str:
    """The input tables as common table expressions; see `inputs`."""
    gw = "CASE WHEN nation = 23 THEN 0 ELSE SUM(value) / 1e6 END" if zero else "SUM(value) / 1e6"
    return f"""
hierarchy AS (
  SELECT n_nationkey AS nation, n_name AS country, n_regionkey AS region,
         CASE WHEN n_nationkey = 24 THEN 'D9' ELSE 'D' || (n_nationkey % 7) END AS d_region
  FROM nation),
lines AS (
  SELECT nation, l_returnflag AS flag, l_linestatus AS status,
         CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN hierarchy ON s_nationkey = nation
  GROUP BY ALL),
sales AS (
  SELECT n_regionkey AS region, n_nationkey AS nation, o_orderpriority AS priority,
         o_orderstatus AS status, year(o_orderdate) AS year,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY ALL),
capacity AS (
  SELECT nation, region, d_region, {gw} AS gw
  FROM sales JOIN hierarchy USING (nation, region) GROUP BY nation, region, d_region),
sizes AS (
  SELECT CAST(substr(p_brand, 7, 2) AS INTEGER) AS brand, {_case("p_type", MINERALS)} AS mineral,
         CAST(SUM(p_size) AS DOUBLE) AS size
  FROM part GROUP BY ALL),
percents AS (
  SELECT DISTINCT d_region, CAST(substr(d_region, 2, 1) AS DOUBLE) AS k FROM hierarchy)"""

K_SQL = f"""
stock AS (
  SELECT nation, region, d_region,
         CASE flag || status WHEN 'AF' THEN 'transmission' WHEN 'AO' THEN 'distribution'
           WHEN 'NF' THEN 'transmission_transformer' WHEN 'NO' THEN 'distribution_transformer'
           ELSE 'genstepup_transformer' END AS measure,
         SUM(value) AS value
  FROM lines JOIN hierarchy USING (nation) WHERE nation <> 20 GROUP BY ALL),
mix AS (
  SELECT region, priority AS line_type, SUM(value) / SUM(SUM(value)) OVER (PARTITION BY region) AS share
  FROM sales GROUP BY region, priority),
km AS (
  SELECT nation, 'transmission' AS system, line_type, value * share AS value
  FROM stock JOIN mix USING (region) WHERE measure = 'transmission'
  UNION ALL
  SELECT nation, 'distribution', '<=1 kV', value * 0.63 FROM stock WHERE measure = 'distribution'
  UNION ALL
  SELECT nation, 'distribution', 'Cable 1-100 kV', value * (1 - 0.63) * CASE WHEN k < 9 THEN k * 12 ELSE 0 END / 100
  FROM stock JOIN percents USING (d_region) WHERE measure = 'distribution'
  UNION ALL
  SELECT nation, 'distribution', 'OH 1-100 kV', value * (1 - 0.63) * (1 - CASE WHEN k < 9 THEN k * 12 ELSE 0 END / 100)
  FROM stock JOIN percents USING (d_region) WHERE measure = 'distribution'),
rates AS (
  SELECT CASE WHEN brand <= 10 THEN 'transmission' ELSE 'distribution' END AS system,
         {_case("brand", LINE_TYPES)} AS line_type, mineral, SUM(size) AS rate
  FROM sizes GROUP BY ALL),
k_tons AS (
  SELECT nation, mineral, SUM(value * rate) AS tons FROM (
    SELECT nation, mineral, value, rate FROM km JOIN rates USING (system, line_type)
    UNION ALL
    SELECT nation, mineral, value, rate
    FROM (SELECT nation, CASE WHEN measure = 'distribution_transformer' THEN 'distribution'
                         ELSE 'transmission' END AS system, value
          FROM stock WHERE measure NOT IN ('transmission', 'distribution'))
    JOIN (SELECT * FROM rates WHERE line_type IS NULL) USING (system))
  GROUP BY ALL),
k AS (
  SELECT nation, region, mineral, 'K' AS source,
         CASE WHEN gw = 0 THEN 'inf'::DOUBLE ELSE tons / gw / 1000 END AS value
  FROM k_tons JOIN capacity USING (nation))"""

D_SQL = f"""
lengths AS (
  SELECT d_region, flag, SUM(value) AS km FROM lines JOIN hierarchy USING (nation)
  WHERE nation <> 24 GROUP BY ALL),
d_parts AS (
  SELECT d_region, CASE flag WHEN 'A' THEN 'HV' WHEN 'N' THEN 'MV' ELSE 'LV' END || ' ' || kind AS component,
         km * CASE kind WHEN 'underground' THEN pct / 100 ELSE 1 - pct / 100 END AS value
  FROM (SELECT d_region, flag, km, k * CASE flag WHEN 'A' THEN 5 WHEN 'N' THEN 10 ELSE 12 END AS pct
        FROM lengths JOIN percents USING (d_region)), (VALUES ('overhead'), ('underground')) v(kind)
  UNION ALL
  SELECT d_region, CASE flag WHEN 'A' THEN 'HV' WHEN 'N' THEN 'MV' ELSE 'LV' END
           || CASE status WHEN 'F' THEN ' transformer' ELSE ' substation' END, km * rate
  FROM lengths JOIN (
    SELECT l_returnflag AS flag, l_linestatus AS status,
           CAST(SUM(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS rate
    FROM lineitem GROUP BY ALL) USING (flag)),
d_total AS (
  SELECT d_region, mineral, SUM(value * rate) AS kg
  FROM d_parts JOIN (SELECT {COMPONENT_CASE} AS component, mineral, SUM(size) * 10 AS rate
                     FROM sizes GROUP BY ALL) USING (component)
  GROUP BY ALL),
d AS (
  SELECT nation, region, mineral, 'D' AS source,
         CASE WHEN kg IS NOT NULL AND gw = 0 THEN 'nan'::DOUBLE
              ELSE kg * (gw / SUM(gw) OVER (PARTITION BY d_region, mineral)) / nullif(gw * 1e6, 0) END AS value
  FROM capacity LEFT JOIN d_total USING (d_region))"""

REGION_SQL = """
intensity AS (
  SELECT region, mineral, source, SUM(value * share) AS value
  FROM (SELECT * FROM k UNION ALL SELECT * FROM d) JOIN (
    SELECT nation, gw / SUM(gw) OVER (PARTITION BY region) AS share FROM capacity) USING (nation)
  GROUP BY ALL)"""

PLAN_SQL = f"""
base AS (
  SELECT region, mineral, AVG(value * 1e-3 * 1e-6 / 8760 / (3.6e-3 * 1e-9)) AS value
  FROM intensity WHERE NOT (source = 'D' AND mineral = 'copper') GROUP BY ALL),
per_head AS (
  SELECT region, 1000 * value / n AS x
  FROM (SELECT region, SUM(value) / 1e7 AS value FROM sales
        WHERE status = 'F' AND year = 1998 GROUP BY ALL)
  JOIN (SELECT n_regionkey AS region, COUNT(*) AS n
        FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL) USING (region)),
ends AS (
  SELECT region, mineral, value AS v2015,
         CASE WHEN isnan(value) OR isnan(projected) THEN NULL
              WHEN value < projected THEN value WHEN value >= projected THEN projected END AS v2050
  FROM (SELECT region, mineral, exp(a + b * ln(x)) AS projected
        FROM per_head, (VALUES ('steel', -1.3::DOUBLE, -0.41::DOUBLE),
          ('aluminium', -1.5::DOUBLE, -0.32::DOUBLE), ('copper', -1.9::DOUBLE, -0.47::DOUBLE))
          c(mineral, a, b))
  LEFT JOIN base USING (region, mineral)),
years AS (SELECT CAST(unnest([2015] || range(2020, 2101, 5)) AS INTEGER) AS year),
coefs AS (
  SELECT region, mineral, year,
         CASE WHEN v2050 IS NULL THEN NULL WHEN year = 2015 THEN v2015 WHEN year >= 2050 THEN v2050
              ELSE v2015 + (v2050 - v2015) * ((year - 2015) / 35) END AS value
  FROM ends, years),
prices AS (
  SELECT CASE p_type {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in MINERALS.items())} END AS mineral,
         CAST(SUM(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS mean
  FROM part GROUP BY ALL),
mineral_cost AS (
  SELECT region, year, SUM(value * (mean / 1000 * (1 + (year - 2015) / 1000)) * 0.13 / (1e-6 * 1e-3 * 1e9)) AS cost
  FROM coefs JOIN prices USING (mineral) GROUP BY ALL),
sectors AS (
  SELECT {_case("c_mktsegment", SECTOR_OF)} AS sector,
         CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) / 100 AS cost
  FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE') GROUP BY ALL)"""

WITH_INTENSITY = f"WITH {inputs_sql()}, {K_SQL}, {D_SQL}, {REGION_SQL}"


def _by_region(t: Tables) -> DataFrame:
    i = inputs(t)
    gw = capacity_total(i.capacity)
    return region_intensity(country_intensity(i, gw), gw, i.hierarchy)


@query(f"""
WITH {inputs_sql()}, {K_SQL}
SELECT country, mineral, 'kg/kW' AS unit, round(value, 8) AS value, source
FROM k JOIN hierarchy USING (nation)
""")
def country_intensity_from_stock(t: Tables) -> DataFrame:
    i = inputs(t)
    gw = capacity_total(i.capacity)
    rows = intensity_from_stock(i.stock, i.line_mix, i.k_intensity, gw, i.hierarchy, i.underground)
    return rounded(rows, 8, "value")


@query(f"""
WITH {inputs_sql()}, {D_SQL}
SELECT country, mineral, 'kg/kW' AS unit, round(value, 8) AS value, source
FROM d JOIN hierarchy USING (nation)
""")
def country_intensity_from_regions(t: Tables) -> DataFrame:
    i = inputs(t)
    gw = capacity_total(i.capacity)
    rows = intensity_from_regions(
        i.line_length, i.underground, i.equipment, i.d_intensity, gw, i.hierarchy
    )
    return rounded(rows, 8, "value")


@query(f"""
{WITH_INTENSITY}
SELECT region + 1 AS region_id, mineral, 'kg/kW' AS unit,
       round(MAX(value) FILTER (source = 'K'), 8) AS "K",
       round(MAX(value) FILTER (source = 'D'), 8) AS "D"
FROM intensity GROUP BY ALL
""")
def region_source_comparison(t: Tables) -> DataFrame:
    return rounded(source_comparison(_by_region(t)), 8, "K", "D")


@query(f"""
{WITH_INTENSITY}
SELECT region + 1 AS region_id, mineral,
       round(AVG(value * 1e-3 * 1e-6 / 8760 / (3.6e-3 * 1e-9)), 8) AS value, 2015 AS year
FROM intensity WHERE NOT (source = 'D' AND mineral = 'copper') GROUP BY ALL
""")
def region_base_year(t: Tables) -> DataFrame:
    return rounded(base_year(mt_per_ej(_by_region(t))), 8, "value")


@query(f"""
{WITH_INTENSITY}, {PLAN_SQL}
SELECT r_name AS region, mineral, year, round(value, 8) AS value
FROM coefs JOIN region ON coefs.region = r_regionkey
""")
def region_coefficients(t: Tables) -> DataFrame:
    coefs = material_coefficients(inputs(t))
    return rounded(keep(coefs, "region", "mineral", "year", "value"), 8, "value")


@query(f"""
WITH {inputs_sql(zero=False)}, {K_SQL}, {D_SQL}, {REGION_SQL}, {PLAN_SQL}
SELECT r_name AS region, sector AS supplysector, sector AS subsector, sector AS stub_technology,
       year, 'non-energy' AS cost_input,
       round(sectors.cost * (m.cost / median(m.cost) OVER (PARTITION BY year, sector)) - m.cost, 8) AS cost
FROM mineral_cost m JOIN region ON m.region = r_regionkey, sectors
""")
def region_nonmaterial_cost(t: Tables) -> DataFrame:
    _, costs = run(inputs(t, zero=False))
    return rounded(costs, 8, "cost")
