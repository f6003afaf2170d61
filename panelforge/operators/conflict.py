"""Key-conflict aggregation: one row per primary key, every other column collected into an array,
plus ``n_distinct_<col>`` = number of distinct non-NULL values of that column in the group.

Semantics (shared with the unit tests and the oracle SQL):

* Arrays keep NULLs and are positionally aligned: element *i* of every array comes from the same
  source row. The rows of a group are collected as one struct per row, so alignment holds by
  construction; ``order_rows`` sorts those structs (all value columns, NULLs first) so the
  arrays are reproducible.
* A row with a NULL in any key column is never merged: it becomes its own output row with
  one-element arrays, and ``n_distinct`` is 0 or 1. Such rows take a map-only branch (no
  shuffle); the key filters of both branches reach the Parquet scan.
* ``n_distinct`` ignores NULLs, compares arrays and structs by value, and is a BIGINT.

Scale. There is exactly one row for each key without NULLs, whatever its number of rows. Nearly all
keys have few: their rows are shuffled once, by key, and collected. A sketch of the most frequent
keys, which is part of the plan (a scan of the key columns, merged from the tasks, nothing runs
while the plan is built), names those with ``hot_rows`` rows or more, at most ``hot_keys`` of them;
they are sent to all tasks as hashes, so their number bounds the broadcast. Rows of these keys are
first dealt over ``pieces`` by a hash of their values, each piece is collected and sorted by itself,
and the sorted pieces of a key are merged into its row; only that merge sees a whole group, which
an array-valued result makes inevitable (Spark holds a row of up to 2 GB). Where the sketch names no
key, adaptive execution drops that branch before it reads anything. A key that the sketch names
wrongly or misses is aggregated all the same: the result is equal for any sketch. An input below
``SMALL_BYTES`` by Spark's statistics, which one task could hold, has no sketch.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.functions.arrays import distinct_non_null_count, hashable_equality, set_input
from panelforge.functions.names import col, quote, resolve
from panelforge.functions.types import contains_map, is_orderable

PREFIX = "n_distinct_"
#: Pieces that the rows of a hot key are dealt over before they are merged.
PIECES = 8
#: Rows from which on a key is hot, and the number of keys that are looked at, at most.
HOT_ROWS, HOT_KEYS = 100_000, 1000
SMALL_BYTES = 64 << 20
#: Column that numbers the rows of one key, and a good number of source rows for each of them.
SEGMENT, SEGMENT_ROWS = "segment", 100_000
#: Keys that a task's sketch counts: it sees every key with more than a few rows in so many.
TRACKED = 10_000


def _any_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [col(k).isNull() for k in keys])


def _all_set(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [col(k).isNotNull() for k in keys])


def split_key_columns(df: DataFrame, primary_key: list[str]) -> tuple[list[str], list[str]]:
    pk = resolve(df.columns, primary_key)
    if not pk:
        raise ValueError("primary_key must name at least one column")
    keyset = {k.lower() for k in pk}
    values = [c for c in df.columns if c.lower() not in keyset]
    types = {f.name: f.dataType for f in df.schema.fields}
    bad = [k for k in pk if contains_map(types[k])]
    if bad:
        raise TypeError(f"key columns cannot hold maps: {bad}")
    return pk, values


def duplicate_keys(df: DataFrame, primary_key: list[str], count_col: str = "n_rows") -> DataFrame:
    """Keys that occur more than once, with their row count. NULL keys group together here."""
    pk = resolve(df.columns, primary_key)
    return (
        df.groupBy(*[col(k) for k in pk])
        .agg(F.count(F.lit(1)).alias(count_col))
        .where(F.col(count_col) > 1)
    )


def duplicate_key_counts(df: DataFrame, primary_key: list[str]) -> DataFrame:
    """One row: complete keys that occur more than once, and the same count with incomplete keys
    included (their NULLs taken as equal, although their rows are never merged)."""
    dup = duplicate_keys(df, primary_key)
    complete = _all_set(resolve(df.columns, primary_key))
    return dup.agg(
        F.coalesce(F.sum(F.when(complete, 1).otherwise(0)), F.lit(0)).cast("long").alias("n_duplicate_keys"),
        F.count(F.lit(1)).alias("n_duplicate_groups"),
    )


def hot_keys_of(rows: DataFrame, hash_col: str, hot_rows: int = HOT_ROWS, hot_keys: int = HOT_KEYS) -> DataFrame:
    """Values of the long column ``hash_col`` that at least ``hot_rows`` rows hold, by a mergeable sketch
    of the most frequent ones: ``hot_keys`` rows at most. ``__pf_count`` is the sketch's number of rows."""
    top = rows.agg(F.expr(f"approx_top_k({quote(hash_col)}, {int(hot_keys)}, {max(TRACKED, int(hot_keys))})").alias("top"))
    return top.select(F.explode("top").alias("e")).where(F.col("e.count") >= int(hot_rows)).select(F.col("e.item").alias(hash_col), F.col("e.count").alias("__pf_count"))


def conflict_aggregate(
    df: DataFrame,
    primary_key: list[str],
    *,
    order_rows: bool = True,
    pieces: int = PIECES,
    hot_rows: int = HOT_ROWS,
    hot_keys: int | None = None,
    prefix: str = PREFIX,
    segment_rows: int | None = None,
) -> DataFrame:
    """Group ``df`` by ``primary_key``; see the module docstring for the exact semantics.

    Output columns: key columns, then for each other column (input order) the array column and
    ``<prefix><column>``. ``pieces``, ``hot_rows`` and ``hot_keys`` (0: no key is looked at, and ``df``
    is not scanned for them; by default ``HOT_KEYS``, or 0 for a small input) set how far the work on
    one key is spread, never the result.

    ``segment_rows``: for keys whose row would be too large. The column ``segment`` follows; a key that
    the sketch names has a row for about each ``segment_rows`` of its source rows, sorted and aligned in
    itself, with the whole key's ``n_distinct``; other keys have their one row, segment 0.
    """
    pk, values = split_key_columns(df, primary_key)
    taken = {c.lower() for c in df.columns}
    clash = [prefix + v for v in values if (prefix + v).lower() in taken]
    if segment_rows and SEGMENT in taken | {(prefix + v).lower() for v in values}:
        clash.append(SEGMENT)
    if clash:
        raise ValueError(f"output names collide with input columns: {clash}")
    types = {f.name: f.dataType for f in df.schema.fields}

    keys = [col(k) for k in pk]
    loose = df.where(_any_null(pk))
    keyed = df.where(_all_set(pk))

    # NULL key: never merged -> one row each, no shuffle
    loose_out = loose.select(
        *keys,
        *[
            e
            for v in values
            for e in (
                F.expr(f"array({quote(v)})").alias(v),
                F.expr(f"CAST(CASE WHEN {quote(v)} IS NULL THEN 0 ELSE 1 END AS BIGINT)").alias(prefix + v),
            )
        ],
    )
    segment = [F.lit(0).cast("long").alias(SEGMENT)] if segment_rows else []
    loose_out = loose_out.select("*", *segment)
    if not values:
        return keyed.select(*keys).distinct().select("*", *segment).union(loose_out)

    ordered = order_rows and all(is_orderable(types[v]) for v in values)
    arrange = F.sort_array if ordered else (lambda rows: rows)
    # nested / binary values: distinct sets gathered with the rows (linear), since
    # array_distinct compares such elements pairwise
    by_set = {v: i for i, v in enumerate(values) if not hashable_equality(types[v])}
    sets = [F.collect_set(set_input(F.col("__pf_row").getField(v), types[v])).alias(f"__pf_set{i}") for v, i in by_set.items()]
    collected = arrange(F.collect_list("__pf_row")).alias("__pf_rows")
    row = F.struct(*[col(v) for v in values]).alias("__pf_row")

    def few(rows: DataFrame) -> DataFrame:
        # rows are shuffled as they are: a collected list cannot shrink map-side, and raw rows are
        # cheaper to move than partial list buffers
        grouped = rows.select(*keys, row).repartition(*keys).groupBy(*keys).agg(collected, *sets)
        return grouped.withColumns({f"__pf_set{i}": F.size(f"__pf_set{i}").cast("long") for i in by_set.values()}) if by_set else grouped

    def many(rows: DataFrame) -> DataFrame:
        piece = F.pmod(F.xxhash64(*[F.to_json(F.struct(col(v))) if contains_map(types[v]) else col(v) for v in values]), F.lit(pieces))
        rows = rows.select(*keys, piece.alias("__pf_piece"), row).repartition(*keys, F.col("__pf_piece"))
        sorted_pieces = rows.groupBy(*keys, F.col("__pf_piece")).agg(collected, *sets)
        return sorted_pieces.groupBy(*keys).agg(
            arrange(F.flatten(F.collect_list("__pf_rows"))).alias("__pf_rows"),
            *[F.size(F.array_distinct(F.flatten(F.collect_list(f"__pf_set{i}")))).cast("long").alias(f"__pf_set{i}") for i in by_set.values()],
        )

    def n_distinct(v: str) -> Column:
        return F.col(f"__pf_set{by_set[v]}") if v in by_set else distinct_non_null_count(f"__pf_rows.{quote(v)}", types[v])

    def finished(merged: DataFrame, count: Callable[[str], Column], *more: Column) -> DataFrame:
        return merged.select(
            *keys,
            *[e for v in values for e in (F.expr(f"__pf_rows.{quote(v)}").alias(v), count(v).cast("long").alias(prefix + v))],
            *more,
        )

    def segmented(rows: DataFrame) -> DataFrame:
        # equal rows differ by the task that reads them, so that they too are dealt over the segments
        text = [F.to_json(F.struct(col(v))) if contains_map(types[v]) else col(v) for v in values]
        part = F.pmod(F.xxhash64(*text, F.spark_partition_id()), F.ceil(F.col("__pf_count") / F.lit(int(segment_rows))).cast("long"))
        parts = rows.select(*keys, part.alias("__pf_segment"), row).repartition(*keys, F.col("__pf_segment"))
        parts = parts.groupBy(*keys, F.col("__pf_segment")).agg(collected)
        # at most hot_keys rows of counts, besides keys with an equal hash
        alike = {v: set_input(col(v), types[v]) if v in by_set else col(v) for v in values}
        counts = rows.groupBy(*[col(k).alias(f"__pf_key{i}") for i, k in enumerate(pk)]).agg(
            *[F.count_distinct(alike[v]).alias(f"__pf_count{i}") for i, v in enumerate(values)]
        )
        same = reduce(lambda a, b: a & b, [col(k) == F.col(f"__pf_key{i}") for i, k in enumerate(pk)])
        merged = parts.join(F.broadcast(counts), same)
        return finished(merged, lambda v: F.col(f"__pf_count{values.index(v)}"), F.col("__pf_segment").alias(SEGMENT))

    if hot_keys is None:
        small = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < SMALL_BYTES
        hot_keys = 0 if small else HOT_KEYS
    if hot_keys > 0:
        hashed = keyed.withColumn("__pf_key", F.xxhash64(*keys))
        hot = F.broadcast(hot_keys_of(hashed, "__pf_key", hot_rows, hot_keys))  # hot_keys numbers at most
        cold = hashed.join(hot, "__pf_key", "left_anti")
        if segment_rows:
            keyed_out = finished(few(cold), n_distinct, *segment).union(segmented(hashed.join(hot, "__pf_key")))
            return keyed_out.union(loose_out)
        merged = few(cold).union(many(hashed.join(hot, "__pf_key", "left_semi")))
    else:
        merged = few(keyed)
    return finished(merged, n_distinct, *segment).union(loose_out)


def key_counts(agg: DataFrame, primary_key: list[str], count_col: str = "n_rows", prefix: str = PREFIX) -> DataFrame:
    """Of a conflict-aggregated table, whole or in segments: the key columns, the number of source rows
    and the ``n_distinct`` columns, one row for each key (NULL keys: one for each source row)."""
    pk = resolve(agg.columns, primary_key)
    counts = [c for c in agg.columns if c.startswith(prefix) and c.removeprefix(prefix) in agg.columns]
    if not counts:
        raise ValueError(f"no '{prefix}*' columns: is this a conflict-aggregated table?")
    alone = F.when(_any_null(pk), F.monotonically_increasing_id()).alias("__pf_alone")
    held = F.size(col(counts[0].removeprefix(prefix))).cast("long").alias("__pf_held")
    rows = agg.select(*[col(k) for k in pk], alone, held, *[col(c) for c in counts])
    totals = rows.groupBy(*[col(k) for k in pk], F.col("__pf_alone")).agg(F.sum("__pf_held").alias(count_col), *[F.max(col(c)).alias(c) for c in counts])
    return totals.drop("__pf_alone")


def nest_children(df: DataFrame, parent_key: list[str], **kwargs) -> DataFrame:
    """Child rows under their parent key as parallel arrays (claim lines under a claim)."""
    return conflict_aggregate(df, parent_key, **kwargs)


def conflict_summary(agg: DataFrame, primary_key: list[str], prefix: str = PREFIX) -> DataFrame:
    """Per value column of a conflict-aggregated table: keys, keys with conflicting values
    (``n_distinct > 1``), their share, and the largest ``n_distinct``."""
    resolve(agg.columns, primary_key)
    nd_cols = [c for c in agg.columns if c.startswith(prefix)]
    if not nd_cols:
        raise ValueError(f"no '{prefix}*' columns: is this a conflict-aggregated table?")
    wide = agg.agg(
        F.count(F.lit(1)).alias("n_keys"),
        *[
            e
            for i, c in enumerate(nd_cols)
            for e in (
                F.coalesce(F.sum(F.when(col(c) > 1, 1).otherwise(0)), F.lit(0)).cast("long").alias(f"c{i}"),
                F.coalesce(F.max(col(c)), F.lit(0)).cast("long").alias(f"m{i}"),
            )
        ],
    )
    stacked = F.array(
        *[
            F.struct(
                F.lit(c[len(prefix):]).alias("column_name"),
                F.col(f"c{i}").alias("n_conflict_keys"),
                F.col(f"m{i}").alias("max_n_distinct"),
            )
            for i, c in enumerate(nd_cols)
        ]
    )
    return wide.select(F.col("n_keys"), F.inline(stacked)).select(
        "column_name",
        "n_keys",
        "n_conflict_keys",
        F.when(F.col("n_keys") > 0, F.col("n_conflict_keys") / F.col("n_keys")).alias("conflict_share"),
        "max_n_distinct",
    )
