"""Multi-year runs that build what is missing: wanted (table, year) pairs less the committed ones.

All missing slices with the same output columns are one plan and one write job: the slices' scans
are stacked with a slice number, written aside in a folder for each, and switched into their places
together (``sinks.switch``). Each slice's folder gets its commit record, ``_SUCCESS`` with table, year and
rows, before it moves. A run that dies has built nothing, or is finished by the next one.
"""

from __future__ import annotations

import json
import logging
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.functions.names import col
from panelforge.plans.stage1 import as_select_spec, select_year
from panelforge.session import observation
from panelforge.sinks.switch import aside, parent_of, recover, switch
from panelforge.sources import hadoop_fs

LOGGER = logging.getLogger(__name__)

COMMITTED = "_SUCCESS"
SLICE = "__pf_slice"


def committed(spark: SparkSession, folders: set[str]) -> set[str]:
    """Datasets directly under ``folders`` whose writing was committed, as qualified paths: one listing a
    folder. Switches that a crash has cut short are finished first."""
    found = set()
    for folder in folders:
        if hadoop_fs.exists(spark, folder):
            recover(spark, folder)
            found |= {path.rpartition("/")[0] for path, _ in hadoop_fs.glob(spark, f"{folder}/*/{COMMITTED}")}
    return found


def _write_slices(spark: SparkSession, base: str, slices: list[tuple[str, int, str, DataFrame]]) -> list[int]:
    """Write (table, year, path, frame) slices with the same columns by one job; the rows of each."""
    root, counts, tagged = aside(base), [], []
    for i, (_, year, _, df) in enumerate(slices):
        counts.append(observation(f"slice_{year}"))
        tagged.append(df.observe(counts[-1], F.count(F.lit(1)).alias("rows")).withColumn(SLICE, F.lit(i)))
    reduce(DataFrame.union, tagged).write.partitionBy(SLICE).parquet(f"{root}/new")
    rows, moves = [int(c.get["rows"]) for c in counts], []
    for i, ((table, year, path, df), n) in enumerate(zip(slices, rows)):
        folder = f"{root}/new/{SLICE}={i}"
        if not n:  # a slice without rows has no folder yet, but its columns
            df.limit(0).coalesce(1).write.mode("overwrite").parquet(folder)
        hadoop_fs.write_text(spark, f"{folder}/{COMMITTED}", json.dumps({"table": table, "year": year, "rows": n}))
        moves.append((folder, path))
    switch(spark, base, root, moves)
    return rows


def backfill_tables(spark: SparkSession, wanted: list[tuple], force: bool = False) -> list[dict]:
    """Stage 1 for every wanted (spec, years) whose output is missing or incomplete (``force``: for all).

    Returns ``{table, year, status, rows, path}`` in the order of ``wanted``, ``status`` being ``existing``
    (then without a row count) or ``built``. Two wanted tables that would write the same output are
    refused before any work starts.
    """
    pairs = [(as_select_spec(spec), year) for spec, years in wanted for year in years]
    targets = [spec.output_path(year) for spec, year in pairs]
    twice = sorted({t for t in targets if targets.count(t) > 1})
    if twice:
        raise ValueError(f"several wanted tables write to {twice}")
    present = set() if force else committed(spark, {parent_of(t) for t in targets})
    report, missing = [], {}
    for (spec, year), path in zip(pairs, targets):
        there = hadoop_fs.qualified(spark, path) in present
        report.append({"table": spec.name, "year": year, "status": "existing" if there else "built", "rows": None, "path": path})
        if not there:
            df = select_year(spark, spec, year)
            columns = tuple((f.name, f.dataType.simpleString()) for f in df.schema.fields)
            missing.setdefault((parent_of(path), columns), []).append((report[-1], df))
    for (base, columns), slices in missing.items():
        names = [name for name, _ in columns]
        frames = [(row["table"], row["year"], row["path"], df.select(*[col(c) for c in names])) for row, df in slices]
        for (row, _), n in zip(slices, _write_slices(spark, base, frames)):
            row["rows"] = n
    LOGGER.info("backfill: %s", {(r["table"], r["year"]): r["status"] for r in report})
    return report


def backfill(spark: SparkSession, spec, years: list[int], force: bool = False) -> list[dict]:
    """``backfill_tables`` for one table: ``{year, status, rows, path}`` in year order."""
    return [{k: v for k, v in row.items() if k != "table"} for row in backfill_tables(spark, [(spec, years)], force=force)]
