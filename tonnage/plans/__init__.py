from tonnage.plans.country import (
    capacity_total,
    equipment_by_region,
    intensity_from_regions,
    intensity_from_stock,
    line_material,
    line_stock,
    lines_by_region,
    own_capacity_intensity,
    region_material,
    tidy_stock,
    transformer_material,
)
from tonnage.plans.inputs import Inputs, read_inputs
from tonnage.plans.regional import (
    base_year,
    coefficients,
    country_intensity,
    driver,
    material_coefficients,
    material_cost,
    mt_per_ej,
    nonmaterial_cost,
    region_intensity,
    run,
    source_comparison,
)

__all__ = [
    "Inputs",
    "base_year",
    "capacity_total",
    "coefficients",
    "country_intensity",
    "driver",
    "equipment_by_region",
    "intensity_from_regions",
    "intensity_from_stock",
    "line_material",
    "line_stock",
    "lines_by_region",
    "material_coefficients",
    "material_cost",
    "mt_per_ej",
    "nonmaterial_cost",
    "own_capacity_intensity",
    "read_inputs",
    "region_intensity",
    "region_material",
    "run",
    "source_comparison",
    "tidy_stock",
    "transformer_material",
]
