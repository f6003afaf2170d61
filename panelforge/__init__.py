"""panelforge — multi-year administrative-record tables on Spark.

Stage 1 (``select_year`` / ``process_year``) projects and reshapes one year of raw Parquet;
Stage 2 (``build_table``) unions the years by name and collapses duplicate keys into aligned
arrays with conflict counts; ``run_qc`` / ``qc_report`` report run quality.
"""

from panelforge.operators import (
    conflict_aggregate,
    conflict_summary,
    duplicate_keys,
    explode_periods,
    key_uniqueness,
    nest_children,
    null_counts,
    profile,
    row_uniqueness,
    schema_drift,
    select_columns,
    union_by_name,
    unpivot_monthly,
)
from panelforge.plans import (
    backfill,
    build_table,
    build_table_df,
    load_years,
    process_year,
    qc_report,
    run_qc,
    select_year,
)
from panelforge.specs import BuildSpec, SelectSpec

__all__ = [
    "BuildSpec",
    "SelectSpec",
    "backfill",
    "build_table",
    "build_table_df",
    "conflict_aggregate",
    "conflict_summary",
    "duplicate_keys",
    "explode_periods",
    "key_uniqueness",
    "load_years",
    "nest_children",
    "null_counts",
    "process_year",
    "profile",
    "qc_report",
    "row_uniqueness",
    "run_qc",
    "schema_drift",
    "select_columns",
    "select_year",
    "union_by_name",
    "unpivot_monthly",
]
