"""Parquet scans: glob scan with lineage (Stage 1), explicit year-range union scan (Stage 2)."""

from __future__ import annotations

import logging
from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.functions.names import col, index_ci
from panelforge.operators.union import conform, target_schema
from panelforge.sources import hadoop_fs
from panelforge.sources.footers import SchemaGroup, data_files, partitioned_base, schema_groups
from panelforge.specs import fill

LOGGER = logging.getLogger(__name__)


def glob_parquet(spark: SparkSession, pattern: str) -> list[str]:
    """Sorted data files that ``pattern`` leads to (in matching folders, too); ``FileNotFoundError``
    when there are none."""
    matched = data_files(spark, pattern)
    if not matched:
        raise FileNotFoundError(f"nothing to read under {pattern}")
    return matched


def lineage_path() -> Column:
    """Source path of each row as a plain path: Spark's ``file:`` URI scheme is removed and
    percent-escapes are decoded; other schemes (``hdfs://``, ``s3a://``) are kept.

    Cheap per row: decoding runs only for paths that hold an escape, and the scheme is removed
    by a prefix test rather than a regular expression.
    """
    p = F.col("_metadata.file_path")
    p = F.when(p.contains("%"), F.url_decode(F.regexp_replace(p, r"\+", "%2B"))).otherwise(p)
    return (
        F.when(p.startswith("file:///"), F.substring(p, 8, 1 << 30))
        .when(p.startswith("file:/"), F.substring(p, 6, 1 << 30))
        .otherwise(p)
    )


def schema_of(df: DataFrame) -> dict[str, str]:
    """``{column: type}`` from the plan (no job)."""
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


def check_against_first(groups: list[SchemaGroup]) -> None:
    """Stage 1 schema rule: the first file fixes the columns; a later file that lacks one of
    them is an error (extra columns are ignored; types are cast to the first file's)."""
    first = index_ci(f.name for f in groups[0].schema.fields)
    problems = []
    for group in groups[1:]:
        have = index_ci(f.name for f in group.schema.fields)
        missing = [first[k] for k in first if k not in have]
        problems += [f"{path}: missing {missing}" for path in group.files if missing]
    if problems:
        raise ValueError("input files do not share the first file's columns:\n" + "\n".join(problems))


def scan(spark: SparkSession, group: SchemaGroup) -> DataFrame:
    """One scan of the group's files, with the columns that their folders stand for."""
    reader = spark.read.schema(group.schema)
    return (reader.option("basePath", group.base) if group.base else reader).parquet(*group.files)


def read_with_lineage(
    spark: SparkSession,
    files: list[str],
    lineage_col: str | None = "filename",
    check_schema: bool = True,
) -> DataFrame:
    """One scan over ``files`` with the first file's schema, plus the lineage column.

    Later files are matched to the first file's columns by name and cast to its types; with
    ``check_schema`` a file lacking one of those columns raises instead of reading as NULL.
    A source that already holds the lineage column is refused.
    """
    if not files:
        raise FileNotFoundError("no input files")
    groups = schema_groups(spark, files) if check_schema else [SchemaGroup(spark.read.parquet(files[0]).schema, files)]
    check_against_first(groups)
    return conform_to_first(spark, groups, groups[0].schema, lineage_col)


def conform_to_first(spark: SparkSession, groups: list[SchemaGroup], first: T.StructType, lineage_col: str | None) -> DataFrame:
    """One scan for each schema, cast to the columns of ``first``, with the lineage column."""
    if lineage_col and lineage_col.lower() in {f.name.lower() for f in first.fields}:
        raise ValueError(f"source already has a column named '{lineage_col}' (the lineage column)")
    target = T.StructType(list(first.fields) + ([T.StructField(lineage_col, T.StringType())] if lineage_col else []))
    frames = [_with_lineage(scan(spark, group), lineage_col) for group in groups]
    return frames[0] if len(groups) == 1 and groups[0].schema == first else reduce(DataFrame.union, [conform(f, target) for f in frames])


def _with_lineage(df: DataFrame, lineage_col: str | None) -> DataFrame:
    return df.select("*", lineage_path().alias(lineage_col)) if lineage_col else df


def year_paths(path_pattern: str, year_min: int, year_max: int, **fmt) -> list[str]:
    """The exact per-year inputs, year_min..year_max inclusive (never a ``*`` over years)."""
    return [fill(path_pattern, year=y, **fmt) for y in range(int(year_min), int(year_max) + 1)]


def verify_paths_exist(spark: SparkSession, paths: list[str]) -> None:
    """``FileNotFoundError`` listing every missing input before any work starts."""
    absent = [p for p in paths if not hadoop_fs.exists(spark, p)]
    if absent:
        raise FileNotFoundError(f"{len(absent)} of {len(paths)} inputs do not exist: " + ", ".join(absent))


def read_year_partitions(spark: SparkSession, path: str, year_col: str, year_min: int, year_max: int) -> DataFrame:
    """Years ``year_min..year_max`` of a dataset with ``<year_col>=<year>`` folders, the year a column of it.

    All years without a folder, or with an empty one, are named in one ``FileNotFoundError`` before
    any work. The range is a predicate on the partition column, so other years' files are never
    listed by a task; files that differ in their columns are conformed, one scan a schema.
    """
    wanted = range(int(year_min), int(year_max) + 1)
    files = {y: data_files(spark, f"{path.rstrip('/')}/{year_col}={y}") for y in wanted}
    absent = [str(y) for y in wanted if not files[y]]
    if absent:
        raise FileNotFoundError(f"{path} lacks {len(absent)} of {len(wanted)} years: {', '.join(absent)}")
    groups = schema_groups(spark, [f for y in wanted for f in files[y]], path)
    if len(groups) == 1:
        whole = spark.read.schema(groups[0].schema).parquet(path)
        return whole.where(col(year_col).between(wanted[0], wanted[-1]))
    frames = [scan(spark, g) for g in groups]
    target = target_schema([f.schema for f in frames], [g.files[0] for g in groups])
    return reduce(DataFrame.union, [conform(f, target) for f in frames])


def read_union(
    spark: SparkSession, paths: list[str], drop_cols: tuple[str, ...] = ("filename",)
) -> DataFrame:
    """All ``paths`` (files or dataset folders) as one table by column name, types widened, lineage dropped.

    The files of a slice may differ like the slices themselves: a column that only some of them
    hold is NULL in the others. There is one scan for each distinct schema, over the files of all
    slices that have it, conformed to the common columns (no shuffle).
    """
    slices = {path: data_files(spark, path) for path in dict.fromkeys(paths)}
    empty = [path for path, files in slices.items() if not files]
    if empty:
        raise FileNotFoundError(f"no data files in: {', '.join(empty)}")
    bases = {path: partitioned_base(path, files) for path, files in slices.items()}
    flat = [f for path, files in slices.items() if not bases[path] for f in files]
    groups = schema_groups(spark, flat) if flat else []
    groups += [g for path, base in bases.items() if base for g in schema_groups(spark, slices[path], base)]
    frames = [scan(spark, g) for g in groups]

    home = {f: i for i, g in enumerate(groups) for f in g.files}
    variants = [(path, i) for path, files in slices.items() for i in dict.fromkeys(home[f] for f in files)]
    several = {path for path, n in Counter(path for path, _ in variants).items() if n > 1}
    labels = [f"{path} ({groups[i].files[0].rpartition('/')[2]} and files like it)" if path in several else path for path, i in variants]
    schemas = [frames[i].schema for _, i in variants]
    for line in drift_lines(schemas, labels, ignore=drop_cols):
        LOGGER.warning("schema drift: %s", line)
    target = target_schema(schemas, labels)  # raises on a conflict, naming the slice
    if len(groups) == 1:
        out = spark.read.schema(groups[0].schema).parquet(*slices) if not groups[0].base else frames[0]
    else:
        out = reduce(DataFrame.union, [conform(f, target) for f in frames])
    return out.drop(*drop_cols)


def drift_lines(schemas: list[T.StructType], labels: list[str], ignore: tuple[str, ...] = ()) -> list[str]:
    """Human-readable drift between slices, from their schemas only (no data is read): columns
    absent from some slices, and columns whose type differs between slices."""
    skip = {c.lower() for c in ignore}
    seen: dict[str, dict[str, str]] = {}
    spelled: dict[str, str] = {}
    for schema, label in zip(schemas, labels):
        for f in schema.fields:
            if f.name.lower() in skip:
                continue
            spelled.setdefault(f.name.lower(), f.name)
            seen.setdefault(f.name.lower(), {})[label] = f.dataType.simpleString()
    out = []
    for key, by_label in seen.items():
        absent = [lb for lb in labels if lb not in by_label]
        if absent:
            out.append(f"column '{spelled[key]}' absent from {absent} (read as NULL there)")
        if len(set(by_label.values())) > 1:
            out.append(f"column '{spelled[key]}' has types {by_label} (widened)")
    return out
