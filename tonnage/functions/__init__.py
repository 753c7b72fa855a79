from tonnage.functions.strict import (
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
    strict_less,
    strict_mean,
    strict_sum,
    to_number,
    zero_if_missing,
)
from tonnage.functions.units import FACTORS, MODEL_YEARS, factor, factors_to, listed_units, unit_path

__all__ = [
    "FACTORS",
    "MODEL_YEARS",
    "factor",
    "factors_to",
    "if_else",
    "is_in",
    "is_missing",
    "label",
    "listed_units",
    "not_in",
    "parse_grouped",
    "piece",
    "r_divide",
    "r_log",
    "recode",
    "strict_less",
    "strict_mean",
    "strict_sum",
    "to_number",
    "unit_path",
    "zero_if_missing",
]
