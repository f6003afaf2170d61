"""Stage 2: per table — all years by name, then key-conflict aggregation or pass-through, then
flat / array / sharded output."""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from panelforge.functions.names import col
from panelforge.operators.conflict import PREFIX, conflict_aggregate
from panelforge.session import observation
from panelforge.sinks.parquet import WriteResult, write_table
from panelforge.sinks.switch import parent_of, recover
from panelforge.sources.parquet import read_union, read_year_partitions, verify_paths_exist
from panelforge.specs import BuildSpec, fill

LOGGER = logging.getLogger(__name__)


def as_build_spec(name: str, spec: BuildSpec | dict) -> BuildSpec:
    return spec if isinstance(spec, BuildSpec) else BuildSpec.from_dict(name, spec)


def load_years(spark: SparkSession, spec: BuildSpec, basepath: str) -> DataFrame:
    """Exactly the years year_min..year_max (all missing inputs reported at once), by name,
    widened, without the lineage column. Replacements of an input that a crash has cut short are
    finished first. With ``year_column`` the input is one dataset partitioned by year."""
    if spec.year_column:
        path = fill(spec.path_pattern, basepath=basepath)
        recover(spark, parent_of(path))
        return read_year_partitions(spark, path, spec.year_column, spec.year_min, spec.year_max).drop("filename")
    paths = [spec.year_path(basepath, y) for y in spec.years]
    for base in dict.fromkeys(parent_of(p) for p in paths):
        recover(spark, base)
    verify_paths_exist(spark, paths)
    LOGGER.info("%s: %d year input(s) %s .. %s", spec.name, len(paths), paths[0], paths[-1])
    return read_union(spark, paths, drop_cols=("filename",))


def build_table_df(
    spark: SparkSession,
    name: str,
    conf: BuildSpec | dict,
    basepath: str,
    loaded: Observation | None = None,
    **aggregate_options,
) -> DataFrame:
    """The Stage 2 table as a lazy plan (key aggregation when ``primary_key`` is set).
    ``loaded``, if given, observes the number of rows read across all years, and with a key the
    numbers of complete keys and of duplicated ones and the largest group."""
    spec = as_build_spec(name, conf)
    df = load_years(spark, spec, basepath)
    if not spec.aggregated:
        return df if loaded is None else df.observe(loaded, F.count(F.lit(1)).alias("rows"))
    out = conflict_aggregate(df, spec.primary_key, **aggregate_options)
    arrays = [c for c in out.columns if c.startswith(PREFIX)]
    if loaded is None:
        return out
    if not arrays:  # keys only: nothing in the output tells how many rows a key had
        return conflict_aggregate(df.observe(loaded, F.count(F.lit(1)).alias("rows")), spec.primary_key, **aggregate_options)
    # counted on the output: an observation beside the scan would keep the key filters from it
    held = F.size(col(arrays[0].removeprefix(PREFIX)))
    complete = reduce(lambda a, b: a & b, [col(k).isNotNull() for k in spec.primary_key])
    none = lambda total: F.coalesce(total, F.lit(0)).cast("long")
    return out.observe(
        loaded,
        none(F.sum(held)).alias("rows"),
        none(F.sum(F.when(complete, 1).otherwise(0))).alias("n_keys"),
        none(F.sum(F.when(held > 1, 1).otherwise(0))).alias("n_duplicate_keys"),
        none(F.max(held)).alias("max_group_rows"),
    )


def build_table(
    spark: SparkSession, name: str, conf: BuildSpec | dict, basepath: str, output_path: str, **aggregate_options
) -> WriteResult:
    """Validate -> verify inputs -> load -> aggregate or not -> write (one of four outcomes).

    Rows loaded and rows written are observed during the write job, with a key also the complete
    keys, the duplicated ones and the largest group; ``WriteResult.stats`` returns them.
    """
    spec = as_build_spec(name, conf)
    loaded = observation("loaded")
    df = build_table_df(spark, name, spec, basepath, loaded=loaded, **aggregate_options)
    res = write_table(
        df,
        output_path,
        table_name=spec.name,
        output_name=spec.formatted_output_name(),
        shard_by=spec.shard_by,
        aggregated=spec.aggregated,
    )
    seen = dict(loaded.get)
    res.stats = {"rows_loaded": int(seen.pop("rows")), **seen}
    LOGGER.info("%s: %s rows loaded, %s rows written to %s", spec.name, f"{res.stats['rows_loaded']:,}", f"{res.rows:,}", res.path)
    return res
