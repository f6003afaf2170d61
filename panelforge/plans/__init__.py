"""User-level entry points composed from sources, operators and sinks."""

from panelforge.plans.backfill import backfill, backfill_tables
from panelforge.plans.qc import qc_report, run_qc
from panelforge.plans.stage1 import process_year, select_year
from panelforge.plans.stage2 import build_table, build_table_df, load_years

__all__ = [
    "backfill",
    "backfill_tables",
    "build_table",
    "build_table_df",
    "load_years",
    "process_year",
    "qc_report",
    "run_qc",
    "select_year",
]
