from tonnage.operators.aggregate import (
    distinct_rows,
    group_centre,
    group_mean,
    group_median,
    group_sum,
    with_group_mean,
    with_group_median,
)
from tonnage.operators.coefficients import (
    convert_to,
    apply_coefficients,
    blend,
    compare_sources,
    convert,
    convert_each,
    derive_units,
    ratio_to,
    recode_and_sum,
    source_differences,
    sum_components,
)
from tonnage.operators.costing import median_scalar, price, residual, scale_by
from tonnage.operators.joins import (
    join_checked,
    join_full,
    join_inner,
    join_left,
    rows_without_match,
    unmatched_keys,
)
from tonnage.operators.fitting import add_sums, fit_line, fit_loglog, loglog_sums
from tonnage.operators.projection import cap_and_hold, interpolate, interpolate_at, loglog_project, per_capita
from tonnage.operators.relational import (
    across,
    bind_rows,
    discard,
    drop_incomplete,
    find_names,
    flag_missing,
    keep,
    longer,
    mutate,
    quoted,
    rename,
    split_missing,
    to_numbers,
    wider,
    wider_found,
    year_table,
)
from tonnage.operators.repair import normal_key, repair_hints
from tonnage.operators.sketches import add_sketches, quantile_sketches, sketched_quantile
from tonnage.operators.shares import (
    allocate,
    child_shares,
    rollup_sum,
    share_of_total,
    split_by_fractions,
    split_by_percent,
    split_by_share,
    tidy_measures,
    weighted_rollup,
)

__all__ = [
    "across",
    "add_sketches",
    "add_sums",
    "allocate",
    "apply_coefficients",
    "bind_rows",
    "blend",
    "cap_and_hold",
    "child_shares",
    "compare_sources",
    "convert",
    "convert_each",
    "convert_to",
    "derive_units",
    "discard",
    "distinct_rows",
    "drop_incomplete",
    "find_names",
    "fit_line",
    "fit_loglog",
    "flag_missing",
    "group_centre",
    "group_mean",
    "group_median",
    "group_sum",
    "interpolate",
    "interpolate_at",
    "join_checked",
    "join_full",
    "join_inner",
    "join_left",
    "keep",
    "loglog_project",
    "loglog_sums",
    "longer",
    "median_scalar",
    "mutate",
    "normal_key",
    "per_capita",
    "price",
    "quantile_sketches",
    "quoted",
    "ratio_to",
    "recode_and_sum",
    "rename",
    "repair_hints",
    "residual",
    "rollup_sum",
    "rows_without_match",
    "scale_by",
    "share_of_total",
    "sketched_quantile",
    "source_differences",
    "split_by_fractions",
    "split_by_percent",
    "split_by_share",
    "split_missing",
    "sum_components",
    "tidy_measures",
    "to_numbers",
    "unmatched_keys",
    "weighted_rollup",
    "wider",
    "wider_found",
    "with_group_mean",
    "with_group_median",
    "year_table",
]
