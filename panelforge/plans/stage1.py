"""Stage 1: per (table, year) — glob the raw files, project, reshape, write one dataset."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from panelforge.operators.project import select_columns
from panelforge.session import observation
from panelforge.operators.reshape import explode_periods, unpivot_monthly
from panelforge.sinks.parquet import WriteResult, write_parquet
from panelforge.sources.parquet import glob_parquet, read_with_lineage
from panelforge.specs import SelectSpec

LOGGER = logging.getLogger(__name__)


def as_select_spec(spec: SelectSpec | dict) -> SelectSpec:
    return spec if isinstance(spec, SelectSpec) else SelectSpec.from_dict(spec)


def select_year(
    spark: SparkSession,
    spec: SelectSpec | dict,
    year: int | None = None,
    check_schema: bool = True,
    loaded: Observation | None = None,
) -> DataFrame:
    """The Stage 1 table for one year as a lazy plan: scan (+ lineage) -> select -> reshape.

    ``explode_arrays`` wins over ``monthly_columns`` when both are set. ``loaded``, if given,
    observes the number of rows read (reported once the plan runs, no extra job).
    """
    spec = as_select_spec(spec)
    pattern = spec.resolved_pattern(year) if year is not None else spec.path_pattern
    files = glob_parquet(spark, pattern)
    LOGGER.info("%s %s: %d input file(s)", spec.name, year, len(files))
    raw = read_with_lineage(spark, files, spec.lineage_col, check_schema=check_schema)
    working = select_columns(raw, spec.columns, spec.lineage_col)
    if loaded is not None:
        working = working.observe(loaded, F.count(F.lit(1)).alias("rows"))
    if spec.explode_arrays:
        return explode_periods(working, spec.period_col, spec.n_periods)
    if spec.monthly_columns:
        return unpivot_monthly(working, spec.period_col, spec.n_periods, spec.monthly_pattern, spec.lineage_col)
    return working


def process_year(
    spark: SparkSession, spec: SelectSpec | dict, year: int, preview: bool = False
) -> WriteResult:
    """Build and write ``<output_dir>/<output_name>.parquet`` for one year (overwrites).

    Rows read and rows written are both observed during the single write job and logged.
    """
    spec = as_select_spec(spec)
    loaded = observation(f"loaded_{year}")
    df = select_year(spark, spec, year, loaded=loaded)
    if preview:
        LOGGER.info("preview:\n%s", "\n".join(str(r) for r in df.limit(5).collect()))
    res = write_parquet(df, spec.output_path(year))
    LOGGER.info("%s %s: %s rows read, %s rows written", spec.name, year, f"{loaded.get['rows']:,}", f"{res.rows:,}")
    return res
