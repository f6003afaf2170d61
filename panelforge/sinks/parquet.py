"""Parquet sinks: per-year Stage 1 output, flat / array / sharded Stage 2 output.

A "file" of the naming contract is a Parquet dataset folder written by all tasks in parallel.
A sharded table is one dataset with a folder for each value of the shard column
(``<table>[_array]/<col>_shard=<v>/``), written in a single pass: a rerun replaces exactly the shards
it writes and leaves the others untouched. The shard column itself stays in the files, with its
type; the folder's column is a copy of it for pruning. A NULL shard value lands in
``__HIVE_DEFAULT_PARTITION__`` and is reported as a warning.

Whatever is replaced is written aside first and switched by a journal (``sinks.switch``), so a run
that dies leaves the old or the new state.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.functions.names import col
from panelforge.session import observation
from panelforge.sinks.switch import aside, parent_of, recover, switch
from panelforge.sources import hadoop_fs

LOGGER = logging.getLogger(__name__)

ARRAY_SUFFIX = "_array"


@dataclass
class WriteResult:
    path: str
    rows: int
    shards: list = field(default_factory=list)
    null_shard_rows: int = 0
    warnings: list[str] = field(default_factory=list)
    stats: dict = field(default_factory=dict)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> WriteResult:
    """Write ``df`` as a Parquet dataset at ``path``; the row count is observed during the write
    (no second job). An existing dataset is replaced once the new one is complete."""
    obs = observation("write")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if mode == "overwrite":
        spark, base = spark_of(df), parent_of(path)
        recover(spark, base, path)
        root = aside(base)
        new = f"{root}/{path.rstrip('/').rpartition('/')[2]}"
        observed.write.parquet(new)
        switch(spark, base, root, [(new, path)])
    else:
        observed.write.mode(mode).parquet(path)
    rows = int(obs.get["rows"])
    LOGGER.info("wrote %s rows to %s", f"{rows:,}", path)
    return WriteResult(path=path, rows=rows)


def shard_folder_column(shard_col: str) -> str:
    return f"{shard_col}_shard"


def write_sharded(df: DataFrame, path: str, shard_col: str, instead_of: str | None = None) -> WriteResult:
    """One pass, a folder for each shard; only the shards present in ``df`` are replaced, and removed
    from the dataset ``instead_of``, if given, in the same switch.

    Rows are rebalanced by shard first (AQE splits large shards and joins small ones), so a shard
    gets a few files however many tasks the upstream plan has. ``shards`` of the result names the
    shards that the dataset holds after the write.
    """
    obs = observation("sharded_write")
    folder = shard_folder_column(shard_col)
    observed = df.withColumn(folder, col(shard_col)).hint("rebalance", col(folder)).observe(
        obs,
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.when(col(shard_col).isNull(), 1).otherwise(0)), F.lit(0)).alias("null_rows"),
    )
    spark, base = spark_of(df), parent_of(path)
    for place in [path, instead_of] if instead_of else [path]:
        recover(spark, base, place)
    root = aside(base)
    observed.write.partitionBy(folder).parquet(f"{root}/new")
    written = shard_folders(spark, f"{root}/new", shard_col)
    stale = [name for name in shard_folders(spark, instead_of, shard_col) if name in set(written)] if instead_of else []
    names = [*written, "_SUCCESS"] if hadoop_fs.exists(spark, f"{root}/new/_SUCCESS") else written
    switch(spark, base, root, [(f"{root}/new/{n}", f"{path}/{n}") for n in names], [f"{instead_of}/{n}" for n in stale])
    if stale:
        LOGGER.info("removed %d stale shard(s) from %s", len(stale), instead_of)
    m = obs.get
    shards = [name.partition("=")[2] for name in shard_folders(spark, path, shard_col)]
    res = WriteResult(path=path, rows=int(m["rows"]), shards=shards, null_shard_rows=int(m["null_rows"]))
    if res.null_shard_rows:
        res.warnings.append(f"{res.null_shard_rows:,} rows without a {shard_col!r} form the shard {folder}=__HIVE_DEFAULT_PARTITION__")
        LOGGER.warning(res.warnings[-1])
    LOGGER.info("wrote %s rows to %s, which holds %d shards", f"{res.rows:,}", path, len(shards))
    return res


def shard_folders(spark, path: str, shard_col: str) -> list[str]:
    """Folder names of the shards under ``path``, as Spark wrote (and escaped) them."""
    return [name for name in hadoop_fs.list_dir(spark, path) if name.startswith(f"{shard_folder_column(shard_col)}=")]


def write_table(
    df: DataFrame,
    output_path: str,
    table_name: str,
    output_name: str,
    shard_by: str | None = None,
    aggregated: bool = False,
) -> WriteResult:
    """The four Stage 2 outcomes:

    ============  ==========================================  ======================================
    sharded       aggregated                                  flat
    ============  ==========================================  ======================================
    no            ``<output_name>_array.parquet``             ``<output_name>.parquet``
    yes           ``<table>_array/<col>_shard=<v>/``          ``<table>/<col>_shard=<v>/``
    ============  ==========================================  ======================================

    When a sharded table switches between aggregated and flat, a written shard's output under
    the other suffix is removed, so each shard has exactly one current output.
    """
    suffix = ARRAY_SUFFIX if aggregated else ""
    base = output_path.rstrip("/")
    if not shard_by:
        return write_parquet(df, f"{base}/{output_name}{suffix}.parquet")
    other = f"{base}/{table_name}{'' if aggregated else ARRAY_SUFFIX}"
    return write_sharded(df, f"{base}/{table_name}{suffix}", shard_by, instead_of=other)


def spark_of(df: DataFrame):
    return df.sparkSession
