"""Material per unit of capacity for every country, from two independent data sets.

Data set K gives each country's grid stock; data set D gives line lengths for larger
regions. Both end as country, mineral, unit, value, source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonnage.functions import factor, if_else, not_in
from tonnage.operators import (
    allocate,
    apply_coefficients,
    bind_rows,
    child_shares,
    convert,
    derive_units,
    discard,
    group_sum,
    keep,
    ratio_to,
    recode_and_sum,
    rename,
    rollup_sum,
    share_of_total,
    split_by_fractions,
    split_by_percent,
    split_by_share,
    split_missing,
    sum_components,
    tidy_measures,
)
from tonnage.sources.schemas import STOCK_MEASURES

# Row label of the grand total and the names of the two systems.
TOTAL_LABEL = "Total"
TRANSMISSION = "transmission"
DISTRIBUTION = "distribution"

# Share of distribution lines at low voltage, and the line labels.
LOW_VOLTAGE_SHARE = 0.63
LOW_VOLTAGE = "<=1 kV"
MEDIUM_CABLE = "Cable 1-100 kV"
MEDIUM_OVERHEAD = "OH 1-100 kV"

# Voltage class, short name, percentage column, overhead and underground label.
VOLTAGE_CLASSES = {"High": "HV", "Medium": "MV", "Low": "LV"}
LINE_CLASSES = {
    "High": ("pct_hv", "HV overhead", "HV underground"),
    "Medium": ("pct_mv", "MV overhead", "MV underground"),
    "Low": ("pct_lv", "LV overhead", "LV underground"),
}

SOURCE_K = "K"
SOURCE_D = "D"


def tidy_stock(stock: DataFrame, hierarchy: DataFrame) -> DataFrame:
    """Country stock, one row per measure, with the country's parents."""
    return tidy_measures(stock, STOCK_MEASURES, "system", hierarchy, {"country": TOTAL_LABEL})


def line_stock(tidy: DataFrame, line_mix: DataFrame, underground: DataFrame) -> DataFrame:
    """Line length per country, system and line type."""
    shares = keep(
        share_of_total(line_mix, ["k_region"], "km", staged=False), "k_region", "line_type", "share"
    )
    high = split_by_share(
        discard(tidy.where(F.col("system") == TRANSMISSION), "d_region"),
        shares,
        ["k_region"],
        "value",
    )
    low = split_by_fractions(
        tidy.where(F.col("system") == DISTRIBUTION),
        "value",
        (LOW_VOLTAGE, LOW_VOLTAGE_SHARE),
        (MEDIUM_CABLE, MEDIUM_OVERHEAD),
        keep(underground, "d_region", "pct_lv"),
        ["d_region"],
        "pct_lv",
        "line_type",
    )
    columns = ["country", "k_region", "system", "line_type", "value"]
    return bind_rows(keep(high, *columns), keep(low, *columns))


def line_material(lines: DataFrame, intensity: DataFrame) -> DataFrame:
    """Tonnes of each mineral in each country's lines."""
    per_km = sum_components(
        intensity, ["system", "line_type", "mineral", "unit"], "intensity", "line_type"
    )
    return apply_coefficients(
        lines, per_km, ["system", "line_type"], "value", "intensity", "tons"
    )


def transformer_material(tidy: DataFrame, intensity: DataFrame) -> DataFrame:
    """Tonnes of each mineral in each country's transformers."""
    _, per_gva = split_missing(intensity, "line_type")
    transformers = tidy.where(not_in("system", [TRANSMISSION, DISTRIBUTION]))
    system = if_else(
        F.col("system") == "distribution_transformer", F.lit(DISTRIBUTION), F.lit(TRANSMISSION)
    )
    stock = recode_and_sum(
        transformers, "system", system, ["country", "system", "k_region", "d_region"], "value"
    )
    return apply_coefficients(
        stock,
        keep(per_gva, "system", "component", "mineral", "intensity", "unit"),
        ["system"],
        "value",
        "intensity",
        "tons",
    )


def capacity_total(capacity: DataFrame) -> DataFrame:
    """Generating capacity per country, in GW."""
    return group_sum(capacity, ["country", "k_region"], "gw")


def intensity_from_stock(
    stock: DataFrame,
    line_mix: DataFrame,
    k_intensity: DataFrame,
    gw: DataFrame,
    hierarchy: DataFrame,
    underground: DataFrame,
) -> DataFrame:
    """Data set K: kg per kW by country and mineral; `gw` is the capacity total."""
    tidy = tidy_stock(stock, hierarchy)
    materials = [
        line_material(line_stock(tidy, line_mix, underground), k_intensity),
        transformer_material(tidy, k_intensity),
    ]
    per_gw = [
        ratio_to(m, gw, ["country", "k_region"], "value", "gw", "t/GW") for m in materials
    ]
    keys = ["country", "k_region", "mineral", "unit"]
    summed = rollup_sum(per_gw, [[*keys, "system"], keys], "value")
    per_kw = convert(
        summed, "value", [("*", factor("t", "kg")), ("/", factor("GW", "kW"))], unit="kg/kW"
    )
    return keep(per_kw, "country", "mineral", "unit", "value").withColumn(
        "source", F.lit(SOURCE_K)
    )


def lines_by_region(line_length: DataFrame, underground: DataFrame) -> DataFrame:
    """Overhead and underground length per region and voltage class."""
    return split_by_percent(
        rename(keep(line_length, "d_region", "voltage", "km"), {"km": "value"}),
        ["d_region"],
        LINE_CLASSES,
        "voltage",
        "value",
        underground,
        "component",
    )


def equipment_by_region(line_length: DataFrame, equipment: DataFrame) -> DataFrame:
    """Transformers and substations per region and voltage class."""
    units = derive_units(
        rename(keep(line_length, "d_region", "voltage", "km"), {"km": "value"}),
        equipment,
        ["voltage"],
        "value",
        "units_per_km",
        "voltage",
        VOLTAGE_CLASSES,
        "unit",
        "component",
    )
    return keep(units, "d_region", "component", "value")


def region_material(
    line_length: DataFrame,
    underground: DataFrame,
    equipment: DataFrame,
    d_intensity: DataFrame,
) -> DataFrame:
    """Kilograms of each mineral in each region's lines and equipment, by component."""
    parts = bind_rows(
        lines_by_region(line_length, underground), equipment_by_region(line_length, equipment)
    )
    return apply_coefficients(
        parts, d_intensity, ["component"], "value", "intensity", "kg", complete=False
    )


def intensity_from_regions(
    line_length: DataFrame,
    underground: DataFrame,
    equipment: DataFrame,
    d_intensity: DataFrame,
    gw: DataFrame,
    hierarchy: DataFrame,
) -> DataFrame:
    """Data set D: kg per kW by country and mineral, allocated by the capacity total `gw`."""
    material = region_material(line_length, underground, equipment, d_intensity)
    totals = group_sum(material, ["d_region", "mineral", "unit"], "value")
    shares = child_shares(gw, hierarchy, ["country", "k_region"], "d_region", "gw", staged=False)
    by_country = allocate(totals, shares, ["d_region"], "value")
    # A country without capacity must come out as NaN, so its capacity is joined again
    # although it also made the share.
    per_kw = ratio_to(
        by_country, gw, ["country", "k_region"], "value", "gw", "kg/kW", factor("GW", "kW"), complete=False
    )
    return keep(per_kw, "country", "mineral", "unit", "value").withColumn(
        "source", F.lit(SOURCE_D)
    )


def own_capacity_intensity(material: DataFrame, d_capacity: DataFrame) -> DataFrame:
    """Variant for data set D: kg per kW by region, over the data set's own capacity in MW."""
    per_kw = ratio_to(
        material, d_capacity, ["d_region"], "value", "mw", "kg/kW", 1000.0, complete=False
    )
    return group_sum(per_kw, ["d_region", "mineral", "unit"], "value")
