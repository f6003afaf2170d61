"""Column expressions and planning helpers (types, arrays, names)."""

from panelforge.functions.arrays import (
    distinct_non_null_count,
    element_at_period,
)
from panelforge.functions.types import SchemaConflictError, widen, widen_all

__all__ = [
    "SchemaConflictError",
    "distinct_non_null_count",
    "element_at_period",
    "widen",
    "widen_all",
]
