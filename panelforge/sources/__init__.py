"""Sources: Parquet scans with lineage, explicit year-range scans, union by name."""

from panelforge.sources.parquet import (
    glob_parquet,
    read_union,
    read_with_lineage,
    schema_of,
    verify_paths_exist,
    year_paths,
)

__all__ = [
    "glob_parquet",
    "read_union",
    "read_with_lineage",
    "schema_of",
    "verify_paths_exist",
    "year_paths",
]
