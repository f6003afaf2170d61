"""Run-quality measures, each a single distributed aggregate.

* ``profile``: row count and NULL count of every column in one pass (no shuffle beyond the
  merge of per-task partial sums).
* ``profile_files``: the same for a written dataset, from its files' footers; a scan only for columns
  whose counts the footers don't hold.
* ``key_uniqueness`` / ``row_uniqueness``: distinct keys (NULL counts as a value, like
  ``SELECT DISTINCT``) or distinct full rows, one shuffle with map-side de-duplication, so a
  key or a row copied into a third of the table is combined before it is shuffled.
* ``schema_drift``: per (slice, column) type, presence, change and non-NULL count.

All take an optional ``group_col`` (e.g. ``year``) so one job reports every slice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.functions.names import col, index_ci, literal_rows, monthly_groups, quote, resolve, sql_literal
from panelforge.operators.union import conform, target_schema
from panelforge.sources.footers import data_files, footer_counts
from panelforge.sources.parquet import read_union


def _groups(group_col: str | None):
    return [col(group_col)] if group_col else []


def stack_checks(df: DataFrame, keep: list[str], entries: list[tuple[str, str, str]]) -> DataFrame:
    """Wide one-row-per-group -> long (check, column_name, value); one generator expression."""
    structs = ", ".join(
        f"named_struct('check', {sql_literal(check)}, 'column_name', CAST({sql_literal(name)} AS STRING), "
        f"'value', CAST({quote(src)} AS BIGINT))"
        for check, name, src in entries
    )
    return df.select(*[col(k) for k in keep], F.expr(f"inline(array({structs}))"))


def profile_wide(df: DataFrame, group_col: str | None = None) -> tuple[DataFrame, list[tuple[str, str, str]]]:
    """One aggregate: row count and NULL count per column (per group), as one wide row per
    group, plus the (check, column, field) entries that name its fields."""
    cols = [c for c in df.columns if c != group_col]
    wide = df.groupBy(*_groups(group_col)).agg(
        F.count(F.lit(1)).alias("__pf_rows"),
        *[F.expr(f"coalesce(sum(CASE WHEN {quote(c)} IS NULL THEN 1 ELSE 0 END), 0)").alias(f"__pf_n{i}") for i, c in enumerate(cols)],
    )
    entries = [("row_count", None, "__pf_rows")] + [("null_count", c, f"__pf_n{i}") for i, c in enumerate(cols)]
    return wide, entries


def profile(df: DataFrame, group_col: str | None = None) -> DataFrame:
    """Long rows ``[group_col,] check, column_name, value`` for ``row_count`` and ``null_count``."""
    wide, entries = profile_wide(df, group_col)
    return stack_checks(wide, [group_col] if group_col else [], entries)


def null_counts(df: DataFrame) -> DataFrame:
    """``column_name, null_count`` for every column (one pass)."""
    return (
        profile(df)
        .where(F.col("check") == "null_count")
        .select("column_name", F.col("value").alias("null_count"))
    )


def profile_files(spark: SparkSession, path: str) -> DataFrame:
    """``profile`` of the dataset at ``path``, whose rows and NULLs the writer has counted for each row
    group. Footers are read by tasks and added up to a line a column; data is read for nested columns
    and for those without statistics in some row group only, all of them in one scan. A column that
    some files lack is NULL in them."""
    files = data_files(spark, path)
    if not files:
        raise FileNotFoundError(f"no data files in: {path}")
    counts = {r.column_name: r for r in footer_counts(spark, files).collect()}  # a row for each column
    whole = counts.pop(None)
    df = read_union(spark, [path], drop_cols=())
    named = index_ci(counts)
    held: dict[str, int] = {}
    for c in df.columns if whole.n_rows is not None else []:
        spellings = [r for name, r in counts.items() if name.lower() == c.lower()]
        nested = not isinstance(df.schema[c].dataType, T.AtomicType)
        if not nested and c.lower() in named and all(r.null_count is not None for r in spellings):
            held[c] = whole.n_rows - sum(r.n_rows - r.null_count for r in spellings)
    rest = [c for c in df.columns if c not in held]
    known = [("row_count", None, whole.n_rows)] if whole.n_rows is not None else []
    known += [("null_count", c, held[c]) for c in df.columns if c in held]
    schema = T.StructType([T.StructField("check", T.StringType()), T.StructField("column_name", T.StringType()), T.StructField("value", T.LongType())])
    out = literal_rows(spark, known, schema)
    if rest:
        scanned = profile(df.select(*[col(c) for c in rest]))
        out = out.union(scanned.where("check = 'null_count'") if known else scanned)
    return out


def _uniqueness(df: DataFrame, cols: list[str], group_col: str | None, distinct_name: str) -> DataFrame:
    g = _groups(group_col)
    per_value = df.groupBy(*g, *[col(c) for c in cols]).agg(F.count(F.lit(1)).alias("__pf_n"))
    out = per_value.groupBy(*g).agg(
        F.coalesce(F.sum("__pf_n"), F.lit(0)).cast("long").alias("row_count"),
        F.count(F.lit(1)).alias(distinct_name),
    )
    return out.select(*g, "row_count", distinct_name, (F.col("row_count") - F.col(distinct_name)).alias("duplicate_count"))


def key_uniqueness(df: DataFrame, primary_key: list[str], group_col: str | None = None) -> DataFrame:
    """``row_count, distinct_pk_count, duplicate_count``; NULL keys count as values."""
    pk = resolve(df.columns, primary_key)
    return _uniqueness(df, pk, group_col, "distinct_pk_count")


def row_uniqueness(df: DataFrame, ignore: tuple[str, ...] = (), group_col: str | None = None) -> DataFrame:
    """``row_count, distinct_row_count, duplicate_count`` over all columns except ``ignore``."""
    skip = {c.lower() for c in ignore} | ({group_col.lower()} if group_col else set())
    cols = [c for c in df.columns if c.lower() not in skip]
    return _uniqueness(df, cols, group_col, "distinct_row_count")


def sample_rows(df: DataFrame, n: int = 100, order_by: list[str] | None = None, hash_of: list[str] | None = None) -> DataFrame:
    """``n`` rows of ``df``, by default any, the first that tasks come upon.

    With ``order_by`` the sample is reproducible: the first ``n`` rows in that order. With ``hash_of`` (``["*"]``:
    all columns) it is spread over the table and reproducible: the ``n`` rows with the smallest MD5
    of these columns' JSON, whatever the files' and tasks' layout; equal digests go by the whole row.
    Both are a top-k (each task keeps its own ``n``; only those are merged), never a full sort.
    """
    if order_by:
        return df.orderBy(*[col(c).asc_nulls_first() for c in resolve(df.columns, order_by)]).limit(int(n))
    if hash_of:
        text = lambda cols: F.to_json(F.struct(*[col(c) for c in cols]), {"ignoreNullFields": "false"})
        names = df.columns if hash_of == ["*"] else resolve(df.columns, hash_of)
        return df.orderBy(F.md5(text(names)), text(df.columns)).limit(int(n))
    return df.limit(int(n))


def missing_columns(columns: list[str], expected: list[str]) -> list[str]:
    """Expected names absent from ``columns`` (case-insensitive), in expected order."""
    have = {c.lower() for c in columns}
    return [e for e in expected if e.lower() not in have]


def expected_columns_report(df: DataFrame, expected: list[str]) -> DataFrame:
    """Per expected column (expected order): ``present`` (case-insensitive match) and
    ``n_non_null`` (its filled values; 0 when absent), from one aggregate over the present ones."""
    have = {c.lower(): c for c in df.columns}
    present = [e for e in expected if e.lower() in have]
    counts = df.agg(
        F.count(F.lit(1)).alias("__pf_rows"),
        *[F.count(col(have[e.lower()])).alias(f"__pf_c{i}") for i, e in enumerate(present)],
    )
    idx = {e: i for i, e in enumerate(present)}
    structs = ", ".join(
        f"named_struct('column_name', {sql_literal(e)}, 'present', {'true' if e in idx else 'false'}, "
        f"'n_non_null', {f'__pf_c{idx[e]}' if e in idx else 'CAST(0 AS BIGINT)'})"
        for e in expected
    )
    return counts.select(F.expr(f"inline(array({structs}))"))


def expected_output_columns(spec) -> list[str]:
    """Columns a Stage 1 output should have, derived after the reshape (a monthly unpivot
    replaces its ``<base>_mo_NN`` names by the base names and the period column)."""
    configured = [c for c in spec.columns if isinstance(c, str)]
    if spec.explode_arrays:
        return configured + [spec.period_col]
    if spec.monthly_columns:
        groups, static = monthly_groups(configured, spec.monthly_pattern, exclude=[spec.lineage_col])
        return static + [spec.period_col] + list(groups)
    return configured


def schema_drift(frames: list[DataFrame], labels: list, label_col: str = "year", counts: bool = False) -> DataFrame:
    """Per (slice, column of the common schema): ``data_type`` in that slice (NULL when absent),
    ``target_type`` after widening, ``present`` and ``type_changed`` (differs from the first slice
    holding the column). These facts come from the schemas; no data is read.

    With ``counts`` also ``n_non_null`` (values the slice contributes; 0 when absent), from one
    aggregate over the conformed union, which reads all slices.
    """
    target = target_schema([f.schema for f in frames], [str(x) for x in labels])
    first_type: dict[str, str] = {}
    meta = []
    for fr, label in zip(frames, labels):
        have = {f.name.lower(): f.dataType.simpleString() for f in fr.schema.fields}
        for f in target.fields:
            t = have.get(f.name.lower())
            if t is not None:
                first_type.setdefault(f.name.lower(), t)
            changed = t is not None and t != first_type[f.name.lower()]
            meta.append((label, f.name, t, f.dataType.simpleString(), t is not None, changed))
    label_type = T.LongType() if all(isinstance(x, int) for x in labels) else T.StringType()
    spark = frames[0].sparkSession
    meta_df = literal_rows(
        spark,
        meta,
        T.StructType(
            [
                T.StructField(label_col, label_type),
                T.StructField("column_name", T.StringType()),
                T.StructField("data_type", T.StringType()),
                T.StructField("target_type", T.StringType()),
                T.StructField("present", T.BooleanType()),
                T.StructField("type_changed", T.BooleanType()),
            ]
        ),
    )
    if not counts:
        return meta_df
    tagged = [
        conform(fr, target).withColumn(label_col, F.lit(label).cast(label_type)) for fr, label in zip(frames, labels)
    ]
    union = tagged[0]
    for t in tagged[1:]:
        union = union.union(t)
    names = [f.name for f in target.fields]
    wide = union.groupBy(col(label_col)).agg(*[F.count(col(c)).alias(f"__pf_c{i}") for i, c in enumerate(names)])
    filled = wide.select(
        col(label_col),
        F.inline(
            F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"__pf_c{i}").alias("n_non_null")) for i, c in enumerate(names)])
        ),
    )
    # both sides are bounded by (slices x columns): metadata, not data
    return meta_df.join(F.broadcast(filled), [label_col, "column_name"], "left").select(
        col(label_col),
        "column_name",
        "data_type",
        "target_type",
        "present",
        "type_changed",
        F.coalesce(F.col("n_non_null"), F.lit(0)).alias("n_non_null"),
    )


__all__ = [
    "expected_columns_report",
    "sample_rows",
    "expected_output_columns",
    "profile_wide",
    "key_uniqueness",
    "missing_columns",
    "null_counts",
    "profile",
    "profile_files",
    "row_uniqueness",
    "schema_drift",
]
