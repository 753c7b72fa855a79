"""Declared schemas of the pipeline's input tables, in file column order.

`c` is text, `n` a double and `i` an integer, the letters the files use in their
own column-type notes.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

_TYPES: dict[str, DataType] = {"c": StringType(), "n": DoubleType(), "i": IntegerType()}


def schema(types: str, *names: str) -> StructType:
    """Schema from one type letter per column name."""
    if len(types) != len(names):
        raise ValueError(f"{len(types)} types for {len(names)} columns")
    return StructType([StructField(n, _TYPES[t]) for t, n in zip(types, names, strict=True)])


# The stock measures, named as the columns of their file.
STOCK_MEASURES = (
    "transmission",
    "distribution",
    "transmission_transformer",
    "distribution_transformer",
    "genstepup_transformer",
)

# Country to its three parents: region of data set K, region of data set D, model region.
HIERARCHY = schema("ccci", "country", "k_region", "d_region", "region_id")
REGIONS = schema("ic", "region_id", "region")

# Data set K. The stock measures arrive as text with "-" for missing.
STOCK = schema("cccccc", "country", *STOCK_MEASURES)
LINE_MIX = schema("ccn", "k_region", "line_type", "km")
CAPACITY = schema("ccn", "country", "k_region", "gw")
K_INTENSITY = schema("ccccnc", "system", "component", "line_type", "mineral", "intensity", "unit")

# Data set D.
UNDERGROUND = schema("cnnnn", "d_region", "income_pc", "pct_hv", "pct_mv", "pct_lv")
LINE_LENGTH = schema(
    "ccn" + "n" * 9, "d_region", "voltage", "km", *[f"other_{i}" for i in range(1, 10)]
)
EQUIPMENT = schema("ccn", "unit", "voltage", "units_per_km")
D_INTENSITY = schema("ccnc", "component", "mineral", "intensity", "unit")

# Model runs, prices and costs.
GENERATION = schema("cccin", "units", "scenario", "region", "year", "value")
POPULATION = schema("ccin", "scenario", "region", "year", "value")
PRICES = schema("ccin", "mineral", "price_unit", "year", "price")
COSTS = schema("ccccin", "sector", "subsector", "technology", "cost_input", "year", "cost")
