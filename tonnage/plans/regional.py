"""From country intensities to regional coefficients and costs on the year grid."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonnage.functions import factor, is_in
from tonnage.functions.units import (
    BASE_YEAR,
    FIXED_CHARGE_RATE,
    MODEL_YEARS,
)
from tonnage.operators import (
    bind_rows,
    blend,
    cap_and_hold,
    child_shares,
    compare_sources,
    convert,
    group_sum,
    interpolate,
    join_left,
    keep,
    loglog_project,
    median_scalar,
    per_capita,
    price,
    rename,
    residual,
    scale_by,
    weighted_rollup,
)
from tonnage.plans.country import (
    SOURCE_D,
    SOURCE_K,
    capacity_total,
    intensity_from_regions,
    intensity_from_stock,
)
from tonnage.plans.inputs import Inputs
from tonnage.sources import stage

# Scenario and years of the projection, and its intercepts and slopes.
SCENARIO = "Reference"
PROJECTION_YEAR = 2050
LAST_YEAR = 2100
PROJECTION = {
    "steel": (-1.3, -0.41),
    "aluminium": (-1.5, -0.32),
    "copper": (-1.9, -0.47),
}

# The mineral for which data set D is not used.
NOT_FROM_D = {"source": SOURCE_D, "mineral": "copper"}

# The sectors whose cost is split.
SECTORS = ("elect_td_bld", "elect_td_ind", "elect_td_trn")

AREA = ["region_id", "region"]


def region_intensity(countries: DataFrame, gw: DataFrame, hierarchy: DataFrame) -> DataFrame:
    """Capacity-weighted kg per kW by model region, mineral and source."""
    shares = child_shares(gw, hierarchy, ["country", "k_region"], "region_id", "gw", staged=False)
    keys = ["region_id", "mineral", "unit", "source"]
    return weighted_rollup(countries, shares, ["country"], keys, "value")


def source_comparison(intensity: DataFrame) -> DataFrame:
    """Both sources side by side."""
    return compare_sources(intensity, "source", [SOURCE_K, SOURCE_D], "value")


def mt_per_ej(intensity: DataFrame) -> DataFrame:
    """kg per kW to Mt per EJ, at full load all year."""
    steps = [
        ("*", factor("kg", "t")),
        ("*", factor("t", "Mt")),
        ("/", factor("kW", "kWh/year")),
        ("/", factor("kWh", "GJ") * factor("GJ", "EJ")),
    ]
    return keep(convert(intensity, "value", steps), "region_id", "mineral", "source", "value")


def base_year(intensity: DataFrame) -> DataFrame:
    """Mean of the sources per region and mineral in the base year."""
    return blend(intensity, NOT_FROM_D, ["region_id", "mineral"], "value", BASE_YEAR)


def driver(generation: DataFrame, population: DataFrame) -> DataFrame:
    """Electricity per head in the projection year, by scenario and region."""
    return per_capita(
        generation,
        population,
        ["units", "scenario", "region", "year"],
        ["scenario", "region", "year"],
        "value",
        "value",
        1000.0,
        F.col("year") == PROJECTION_YEAR,
        ["scenario", "region", "value"],
    )


def projected(per_head: DataFrame) -> DataFrame:
    """Projected intensity per region and mineral in the projection year."""
    chosen = per_head.where(F.col("scenario") == SCENARIO)
    rows = loglog_project(rename(chosen, {"value": "per_head"}), "per_head", PROJECTION, "mineral", "value")
    return keep(rows, "region", "mineral", "value")


def coefficients(per_head: DataFrame, base: DataFrame, regions: DataFrame) -> DataFrame:
    """Mt per EJ by region, mineral and model year."""
    known = cap_and_hold(
        join_left(projected(per_head), regions),
        rename(base, {"value": "base"}),
        ["region_id", "mineral"],
        "value",
        "base",
        (BASE_YEAR, PROJECTION_YEAR, LAST_YEAR),
    )
    return interpolate(known, [*AREA, "mineral"], "year", "value", MODEL_YEARS)


def material_cost(coefs: DataFrame, prices: DataFrame) -> DataFrame:
    """Levelised material cost per GJ by region and year."""
    per_gj = factor("t", "Mt") * factor("kg", "t") * factor("EJ", "GJ")
    rows = price(
        coefs, prices, ["mineral", "year"], "value", "price", FIXED_CHARGE_RATE, per_gj, "cost"
    )
    return group_sum(rows, [*AREA, "year"], "cost", "mineral_cost")


def nonmaterial_cost(mineral_cost: DataFrame, costs: DataFrame) -> DataFrame:
    """Regional total cost less its material part, by sector and year."""
    scalars = keep(median_scalar(mineral_cost, ["year"], "mineral_cost"), *AREA, "year", "scalar")
    sectors = costs.where(is_in("sector", SECTORS))
    total = scale_by(scalars, sectors, ["year"], "cost")
    total = keep(total, *AREA, "sector", "subsector", "technology", "year", "cost_input", "cost")
    return residual(total, mineral_cost, [*AREA, "year"], "cost", "mineral_cost")


def country_intensity(tables: Inputs, gw: DataFrame) -> DataFrame:
    """kg per kW by country and mineral from both data sets."""
    t = tables
    return bind_rows(
        intensity_from_stock(t.stock, t.line_mix, t.k_intensity, gw, t.hierarchy, t.underground),
        intensity_from_regions(
            t.line_length, t.underground, t.equipment, t.d_intensity, gw, t.hierarchy
        ),
    )


def material_coefficients(tables: Inputs) -> DataFrame:
    """Mt per EJ by region, mineral and model year, from the input tables.

    Tables by country and region are small, so nothing is staged on the way.
    """
    t = tables
    gw = capacity_total(t.capacity)
    base = base_year(mt_per_ej(region_intensity(country_intensity(t, gw), gw, t.hierarchy)))
    return coefficients(driver(t.generation, t.population), base, t.regions)


def run(tables: Inputs) -> tuple[DataFrame, DataFrame]:
    """Both results of the plan: material coefficients and non-material costs.

    The coefficients make both results and the material cost is read three times, so both
    are staged; with the median's two tables the plan writes four.
    """
    coefs = stage(material_coefficients(tables))
    cost = stage(material_cost(coefs, tables.prices))
    return (
        keep(coefs, "region", "mineral", "year", "value"),
        rename(
            keep(
                nonmaterial_cost(cost, tables.costs),
                "region", "sector", "subsector", "technology", "year", "cost_input", "cost",
            ),
            {"sector": "supplysector", "technology": "stub_technology"},
        ),
    )
