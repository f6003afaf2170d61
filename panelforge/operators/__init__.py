"""DataFrame -> DataFrame operators (no I/O)."""

from panelforge.operators.conflict import (
    conflict_aggregate,
    conflict_summary,
    duplicate_key_counts,
    duplicate_keys,
    nest_children,
)
from panelforge.operators.project import select_columns
from panelforge.operators.quality import (
    key_uniqueness,
    missing_columns,
    null_counts,
    profile,
    row_uniqueness,
    schema_drift,
)
from panelforge.operators.reshape import explode_periods, unpivot_monthly
from panelforge.operators.union import union_by_name

__all__ = [
    "conflict_aggregate",
    "conflict_summary",
    "duplicate_key_counts",
    "duplicate_keys",
    "explode_periods",
    "key_uniqueness",
    "missing_columns",
    "nest_children",
    "null_counts",
    "profile",
    "row_uniqueness",
    "schema_drift",
    "select_columns",
    "union_by_name",
    "unpivot_monthly",
]
