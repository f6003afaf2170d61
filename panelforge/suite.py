"""Queries over the shared test tables, each paired with equivalent DuckDB SQL.

Every query reads whole tables (or tables Spark derives from them) through the library's
operators; the SQL states the same result independently, for the oracle comparison. Arrays are
compared in a defined order: the library sorts each group's rows by all value columns with NULLs
first, and the SQL aggregates with the same ``ORDER BY``.

Queries that exercise the file layer (year slices, sharded output, backfill) stage their inputs
under the shared checkpoint folder (``spark.checkpoint.dir``) first.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.functions.names import literal_rows
from panelforge.operators.conflict import SEGMENT_ROWS, conflict_aggregate, conflict_summary, duplicate_key_counts, duplicate_keys, key_counts, nest_children
from panelforge.operators.project import select_columns
from panelforge.operators.quality import (
    expected_columns_report,
    key_uniqueness,
    null_counts,
    profile_files,
    row_uniqueness,
    sample_rows,
    schema_drift,
)
from panelforge.operators.reshape import explode_periods, unpivot_monthly
from panelforge.plans.backfill import backfill, backfill_tables
from panelforge.plans.qc import qc_report, run_qc
from panelforge.plans.stage1 import process_year, select_year
from panelforge.plans.stage2 import build_table, load_years
from panelforge.session import scratch_path
from panelforge.sinks.parquet import shard_folders, write_parquet, write_table
from panelforge.sinks.switch import aside, record
from panelforge.sources import hadoop_fs
from panelforge.specs import BuildSpec, SelectSpec
from panelforge.streaming.incremental import run_incremental

YEARS = list(range(1995, 2002))

# ---------------------------------------------------------------------------------------------
# shared helpers


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def check_years(df: DataFrame, ts_col: str, years: list[int] = YEARS) -> None:
    """Slices cover all rows: a date outside ``years``, or none, is an error and never a lost row."""
    outside = df.where(F.col(ts_col).isNull() | ~F.year(ts_col).between(years[0], years[-1])).limit(1).count()
    if outside:
        raise ValueError(f"{ts_col} holds rows outside {years[0]}..{years[-1]}")


def year_slice(df: DataFrame, ts_col: str, year: int) -> DataFrame:
    """Rows of one calendar year as a range predicate, so the filter reaches the Parquet scan."""
    return df.where(
        (F.col(ts_col) >= F.lit(f"{year}-01-01").cast("timestamp_ntz"))
        & (F.col(ts_col) < F.lit(f"{year + 1}-01-01").cast("timestamp_ntz"))
    )


def _order_by(cols: list[str]) -> str:
    return ", ".join(f"{c} NULLS FIRST" for c in cols)


def conflict_sql(src: str, pk: list[str], values: list[str]) -> str:
    """Key-conflict aggregation in SQL: keyed rows grouped, NULL-key rows kept alone."""
    keys = ", ".join(pk)
    row = ", ".join(f"{v} := {v}" for v in values)
    # the rows of a group are sorted once, as structs (NULLs first), and then taken apart
    grouped = ", ".join(
        f"list_transform(r, lambda x: x.{v}) AS {v}, "
        f"CAST(len(list_distinct(list_filter(list_transform(r, lambda x: x.{v}), lambda x: x IS NOT NULL))) AS BIGINT) AS n_distinct_{v}"
        for v in values
    )
    alone = ", ".join(
        f"[{v}] AS {v}, CAST(CASE WHEN {v} IS NULL THEN 0 ELSE 1 END AS BIGINT) AS n_distinct_{v}" for v in values
    )
    all_set = " AND ".join(f"{k} IS NOT NULL" for k in pk)
    any_null = " OR ".join(f"{k} IS NULL" for k in pk)
    return (
        f"WITH src AS ({src}) "
        f"SELECT {keys}, {grouped} FROM (SELECT {keys}, list_sort(list(struct_pack({row})), 'ASC', 'NULLS FIRST') AS r "
        f"FROM src WHERE {all_set} GROUP BY {keys}) "
        f"UNION ALL "
        f"SELECT {keys}, {alone} FROM src WHERE {any_null}"
    )


LINEITEM_PK = ["l_orderkey", "l_linenumber"]
LINEITEM_VALUES = [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]

# ---------------------------------------------------------------------------------------------
# key-conflict aggregation


def _lineitem(spark, sf_dir):
    """``lineitem`` with the ship date as text (arrays of timestamps can't be compared by every
    checker) and NULLs in two value columns."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        *LINEITEM_PK,
        *[
            F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipdate") if v == "l_shipdate"
            else F.nullif(F.col(v), F.lit("R")).alias(v) if v == "l_returnflag"
            else F.nullif(F.col(v), F.lit(0)).alias(v) if v == "l_tax"
            else F.col(v)
            for v in LINEITEM_VALUES
        ],
    )


LINEITEM_SQL = (
    "SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate, nullif(l_returnflag, 'R') AS l_returnflag, "
    "nullif(l_tax, 0) AS l_tax{more}) FROM lineitem"
)


def q_conflict_aggregate(spark, sf_dir):
    return conflict_aggregate(_lineitem(spark, sf_dir), LINEITEM_PK)


def sql_conflict_aggregate():
    return conflict_sql(LINEITEM_SQL.format(more=""), LINEITEM_PK, LINEITEM_VALUES)


def _lineitem_null_linenumber(spark, sf_dir):
    return _lineitem(spark, sf_dir).withColumn("l_linenumber", F.nullif(F.col("l_linenumber"), F.lit(3)))


def q_conflict_null_key(spark, sf_dir):
    return conflict_aggregate(_lineitem_null_linenumber(spark, sf_dir), LINEITEM_PK)


def sql_conflict_null_key():
    src = LINEITEM_SQL.format(more=", nullif(l_linenumber, 3) AS l_linenumber")
    return conflict_sql(src, LINEITEM_PK, LINEITEM_VALUES)


def q_conflict_array_column(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    src = li.select("l_orderkey", F.array("l_linestatus", "l_returnflag").alias("flags"), "l_quantity")
    return conflict_aggregate(src, ["l_orderkey"])


def sql_conflict_array_column():
    src = "SELECT l_orderkey, [l_linestatus, l_returnflag] AS flags, l_quantity FROM lineitem"
    return conflict_sql(src, ["l_orderkey"], ["flags", "l_quantity"])


def q_duplicate_keys(spark, sf_dir):
    return duplicate_keys(table(spark, sf_dir, "lineitem"), LINEITEM_PK)


def sql_duplicate_keys():
    return (
        "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem "
        "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"
    )


def q_nest_children(spark, sf_dir):
    return nest_children(table(spark, sf_dir, "conversations"), ["conv_id"])


def sql_nest_children():
    return conflict_sql("SELECT * FROM conversations", ["conv_id"], ["turn", "role", "text"])


def q_conflict_summary(spark, sf_dir):
    return conflict_summary(q_conflict_aggregate(spark, sf_dir), LINEITEM_PK)


def sql_conflict_summary():
    parts = [
        f"SELECT '{v}' AS column_name, count(*) AS n_keys, "
        f"count(*) FILTER (WHERE n_distinct_{v} > 1) AS n_conflict_keys, "
        f"(count(*) FILTER (WHERE n_distinct_{v} > 1)) / count(*) AS conflict_share, "
        f"CAST(coalesce(max(n_distinct_{v}), 0) AS BIGINT) AS max_n_distinct FROM agg"
        for v in LINEITEM_VALUES
    ]
    inner = sql_conflict_aggregate()
    return f"WITH agg AS ({inner}) " + " UNION ALL ".join(parts)


HOT_COLUMNS = ["l_partkey", "l_returnflag", "l_shipdate"]


def q_conflict_hot_key(spark, sf_dir):
    """Lines 1 and 2 of every order share one key (about 45% of all rows): one row, as any key."""
    hot = F.when(F.col("l_linenumber") <= 2, F.lit(0)).otherwise(F.col("l_orderkey")).cast("long")
    lines = _lineitem(spark, sf_dir).withColumn("l_orderkey", hot)
    agg = conflict_aggregate(lines, ["l_orderkey"], hot_rows=1000, hot_keys=100, segment_rows=SEGMENT_ROWS)
    return key_counts(agg, ["l_orderkey"]).select("l_orderkey", "n_rows", *[F.col(f"n_distinct_{c}") for c in HOT_COLUMNS])


def sql_conflict_hot_key():
    nd = ", ".join(f"CAST(count(DISTINCT {c}) AS BIGINT) AS n_distinct_{c}" for c in HOT_COLUMNS)
    src = LINEITEM_SQL.format(more=", CAST(CASE WHEN l_linenumber <= 2 THEN 0 ELSE l_orderkey END AS BIGINT) AS l_orderkey")
    return f"SELECT l_orderkey, count(*) AS n_rows, {nd} FROM ({src}) GROUP BY l_orderkey"


def q_duplicate_key_counts(spark, sf_dir):
    return duplicate_key_counts(_lineitem_null_linenumber(spark, sf_dir), LINEITEM_PK)


def sql_duplicate_key_counts():
    src = LINEITEM_SQL.format(more=", nullif(l_linenumber, 3) AS l_linenumber")
    return (
        "SELECT CAST(count(*) FILTER (WHERE l_linenumber IS NOT NULL) AS BIGINT) AS n_duplicate_keys, count(*) AS n_duplicate_groups "
        f"FROM (SELECT l_orderkey, l_linenumber FROM ({src}) GROUP BY ALL HAVING count(*) > 1)"
    )


# ---------------------------------------------------------------------------------------------
# reshapes


def q_explode_periods(spark, sf_dir):
    return explode_periods(table(spark, sf_dir, "embeddings"), period_col="dim", n_periods=64)


def sql_explode_periods():
    return (
        "SELECT vec_id, label, CAST(p AS INTEGER) AS dim, embedding[p] AS embedding "
        "FROM embeddings CROSS JOIN range(1, 65) t(p)"
    )


def _monthly(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        "o_custkey",
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("mo"),
        "o_totalprice",
    )


def _monthly_wide(spark, sf_dir, name: Callable[[str, int], str], skip: tuple[int, ...] = ()) -> DataFrame:
    m = _monthly(spark, sf_dir)
    aggs = []
    for i in range(1, 13):
        if i in skip:
            continue
        aggs.append(F.max(F.when(F.col("mo") == i, F.col("o_totalprice"))).alias(name("max_price", i)))
        aggs.append(F.count(F.when(F.col("mo") == i, 1)).alias(name("n_orders", i)))
    return m.groupBy("o_custkey", "year").agg(*aggs)


def _mo(base: str, i: int) -> str:
    return f"{base}_mo_{i:02d}"


def q_explode_ragged_arrays(spark, sf_dir):
    m = _monthly(spark, sf_dir)
    wide = m.groupBy("o_custkey", "year").agg(
        F.max("mo").alias("last_mo"),
        *[F.max(F.when(F.col("mo") == i, F.col("o_totalprice"))).alias(f"p{i}") for i in range(1, 13)],
        *[F.count(F.when(F.col("mo") == i, 1)).alias(f"c{i}") for i in range(1, 13)],
    )
    arrays = wide.select(
        "o_custkey",
        "year",
        F.slice(F.array(*[f"p{i}" for i in range(1, 13)]), 1, F.col("last_mo")).alias("max_price"),
        F.slice(F.array(*[f"c{i}" for i in range(1, 13)]), 1, F.col("last_mo")).alias("n_orders"),
    )
    return explode_periods(arrays, period_col="month", n_periods=12)


_MONTHLY_CTE = (
    "WITH m AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, "
    "CAST(month(o_orderdate) AS INTEGER) AS mo, o_totalprice FROM orders), "
    "per_month AS (SELECT o_custkey, year, mo, max(o_totalprice) AS mp, count(*) AS c FROM m GROUP BY ALL), "
    "keys AS (SELECT o_custkey, year, max(mo) AS last_mo FROM m GROUP BY ALL), "
    "grid AS (SELECT k.o_custkey, k.year, k.last_mo, CAST(t.p AS INTEGER) AS month, a.mp, a.c "
    "FROM keys k CROSS JOIN range(1, 13) t(p) "
    "LEFT JOIN per_month a ON a.o_custkey = k.o_custkey AND a.year = k.year AND a.mo = t.p) "
)


def sql_explode_ragged_arrays():
    return _MONTHLY_CTE + (
        "SELECT o_custkey, year, month, "
        "CASE WHEN month <= last_mo THEN mp END AS max_price, "
        "CASE WHEN month <= last_mo THEN coalesce(c, 0) END AS n_orders FROM grid"
    )


def q_unpivot_monthly(spark, sf_dir):
    return unpivot_monthly(_monthly_wide(spark, sf_dir, _mo))


def sql_unpivot_monthly():
    return _MONTHLY_CTE + "SELECT o_custkey, year, month, mp AS max_price, coalesce(c, 0) AS n_orders FROM grid"


def q_unpivot_sparse(spark, sf_dir):
    return unpivot_monthly(_monthly_wide(spark, sf_dir, _mo, skip=(5,)))


def sql_unpivot_sparse():
    return _MONTHLY_CTE + (
        "SELECT o_custkey, year, month, CASE WHEN month <> 5 THEN mp END AS max_price, "
        "CASE WHEN month <> 5 THEN coalesce(c, 0) END AS n_orders FROM grid"
    )


CUSTOM_PATTERN = r"^(max_price|n_orders)_(\d{2})$"


def q_unpivot_custom_pattern(spark, sf_dir):
    wide = _monthly_wide(spark, sf_dir, lambda b, i: f"{b}_{i:02d}")
    # one month stored as text: the base widens to string; a look-alike static column stays static
    wide = wide.withColumn("n_orders_12", F.col("n_orders_12").cast("string"))
    wide = wide.withColumn("n_orders_total", sum(F.col(f"n_orders_{i:02d}").cast("long") for i in range(1, 13)))
    return unpivot_monthly(wide, period_col="month", n_periods=12, pattern=CUSTOM_PATTERN)


def sql_unpivot_custom_pattern():
    return _MONTHLY_CTE + (
        ", totals AS (SELECT o_custkey, year, count(*) AS n_orders_total FROM m GROUP BY ALL) "
        "SELECT g.o_custkey, g.year, t.n_orders_total, g.month, g.mp AS max_price, "
        "CAST(coalesce(g.c, 0) AS VARCHAR) AS n_orders "
        "FROM grid g JOIN totals t ON t.o_custkey = g.o_custkey AND t.year = g.year"
    )


# ---------------------------------------------------------------------------------------------
# projection with lineage (Stage 1 scan)

LINEAGE_COLUMNS = ["l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"]


def q_select_with_lineage(spark, sf_dir):
    spec = SelectSpec(name="lineitem", path_pattern=f"{sf_dir.rstrip('/')}/lineitem.parquet", columns=LINEAGE_COLUMNS)
    df = select_year(spark, spec)
    return df.withColumn("filename", F.substring_index("filename", "/", -1))


def sql_select_with_lineage():
    return f"SELECT {', '.join(LINEAGE_COLUMNS)}, 'lineitem.parquet' AS filename FROM lineitem"


# ---------------------------------------------------------------------------------------------
# year slices of orders on disk: union by name, year ranges, shards, backfill


def _slice_variant(df: DataFrame, year: int) -> DataFrame:
    """Schema drift across years, as Stage 1 outputs show it."""
    df = df.withColumn("year", F.lit(year))
    if year == 1996:
        return df.drop("o_orderpriority")
    if year == 1997:
        return df.withColumn("o_custkey", F.col("o_custkey").cast("int"))
    if year == 1998:
        return df.withColumn("o_custkey", F.col("o_custkey").cast("string"))
    if year == 1999:
        return df.withColumn("o_orderyear", F.year("o_orderdate"))
    if year == 2000:
        return df.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(12,2)"))
    return df


def _sql_slice(year: int) -> str:
    base = (
        f"SELECT *, CAST({year} AS INTEGER) AS year FROM orders "
        f"WHERE o_orderdate >= TIMESTAMP '{year}-01-01' AND o_orderdate < TIMESTAMP '{year + 1}-01-01'"
    )
    variant = {
        1996: f"SELECT * EXCLUDE (o_orderpriority) FROM ({base})",
        1997: f"SELECT * REPLACE (CAST(o_custkey AS INTEGER) AS o_custkey) FROM ({base})",
        1998: f"SELECT * REPLACE (CAST(o_custkey AS VARCHAR) AS o_custkey) FROM ({base})",
        1999: f"SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_orderyear FROM ({base})",
        2000: f"SELECT * REPLACE (CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice) FROM ({base})",
    }
    return variant.get(year, base)


def _sql_union(years: list[int]) -> str:
    return " UNION ALL BY NAME ".join(f"({_sql_slice(y)})" for y in years)


def stage_order_slices(spark: SparkSession, sf_dir: str, years: list[int] = YEARS) -> str:
    """Write one Parquet dataset per year (``orders_<year>.parquet``); returns the folder."""
    base = scratch_path(spark, "orders-slices")
    orders = table(spark, sf_dir, "orders")
    check_years(orders, "o_orderdate")

    def write(y: int) -> None:
        write_parquet(_slice_variant(year_slice(orders, "o_orderdate", y), y), f"{base}/orders_{y}.parquet")

    with ThreadPoolExecutor(max_workers=len(years)) as pool:  # independent jobs, run side by side
        list(pool.map(write, years))
    return base


def _orders_spec(year_min: int, year_max: int, **kw) -> BuildSpec:
    return BuildSpec(
        name="orders",
        year_min=year_min,
        year_max=year_max,
        path_pattern="{basepath}/orders_{year}.parquet",
        output_name="orders_{year_min}_{year_max}",
        **kw,
    )


def q_union_by_name(spark, sf_dir):
    base = stage_order_slices(spark, sf_dir)
    return load_years(spark, _orders_spec(YEARS[0], YEARS[-1]), base)


def sql_union_by_name():
    return _sql_union(YEARS)


def q_year_range(spark, sf_dir):
    base = stage_order_slices(spark, sf_dir)
    return load_years(spark, _orders_spec(1996, 1998), base)


def sql_year_range():
    return _sql_union([1996, 1997, 1998])


def q_schema_drift(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    check_years(orders, "o_orderdate")
    frames = [_slice_variant(year_slice(orders, "o_orderdate", y), y) for y in YEARS]
    return schema_drift(frames, YEARS, label_col="slice_year", counts=True)


def sql_schema_drift():
    # types per slice as Spark names them; counts from the data
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "year", "o_orderyear"]
    target = {
        "o_orderkey": "bigint", "o_custkey": "string", "o_orderstatus": "string", "o_totalprice": "double",
        "o_orderdate": "timestamp_ntz", "o_orderpriority": "string", "year": "int", "o_orderyear": "int",
    }

    def slice_type(c: str, y: int):
        if c == "o_orderpriority" and y == 1996:
            return None
        if c == "o_orderyear" and y != 1999:
            return None
        if c == "o_custkey":
            return {1997: "int", 1998: "string"}.get(y, "bigint")
        if c == "o_totalprice" and y == 2000:
            return "decimal(12,2)"
        return target[c]

    meta = []
    first_type: dict[str, str] = {}
    for y in YEARS:
        for c in cols:
            t = slice_type(c, y)
            if t is not None:
                first_type.setdefault(c, t)
            changed = t is not None and t != first_type[c]
            tt = "NULL" if t is None else f"'{t}'"
            meta.append(
                f"({y}, '{c}', {tt}, '{target[c]}', {'true' if t else 'false'}, {'true' if changed else 'false'})"
            )
    counts = " UNION ALL ".join(
        f"SELECT CAST(year(o_orderdate) AS BIGINT) AS slice_year, '{c}' AS column_name, "
        + (
            "count(*)"
            if c in ("year",)
            else (
                "count(*) FILTER (WHERE year(o_orderdate) = 1999)" if c == "o_orderyear"
                else "count(*) FILTER (WHERE year(o_orderdate) <> 1996)" if c == "o_orderpriority"
                else f"count({c})"
            )
        )
        + " AS n_non_null FROM orders GROUP BY 1"
        for c in cols
    )
    return (
        "WITH meta(slice_year, column_name, data_type, target_type, present, type_changed) AS "
        f"(VALUES {', '.join(meta)}), counts AS ({counts}) "
        "SELECT CAST(m.slice_year AS BIGINT) AS slice_year, m.column_name, m.data_type, m.target_type, m.present, "
        "m.type_changed, coalesce(c.n_non_null, 0) AS n_non_null "
        "FROM meta m LEFT JOIN counts c ON c.slice_year = m.slice_year AND c.column_name = m.column_name"
    )


def stage_mixed_slices(spark: SparkSession, sf_dir: str) -> str:
    """Slices whose files differ, as repeated deliveries leave them: even years have files without the
    priority and files with a text customer key and lineage, odd years files with a column of their own."""
    base = scratch_path(spark, "orders-mixed")
    orders = table(spark, sf_dir, "orders")
    check_years(orders, "o_orderdate")
    for y in YEARS:
        own = year_slice(orders, "o_orderdate", y).withColumn("filename", F.lit(f"raw_{y}"))
        even, odd = own.where("o_orderkey % 2 = 0"), own.where("o_orderkey % 2 <> 0")
        if y % 2 == 0:
            even, odd = even.drop("o_orderpriority", "filename"), odd.withColumn("o_custkey", F.col("o_custkey").cast("string"))
        else:
            odd = odd.drop("o_orderstatus").withColumn("o_late", F.month("o_orderdate") > 6)
        for part in (even, odd):
            part.write.mode("append").parquet(f"{base}/orders_{y}.parquet")
    return base


def q_union_mixed_slices(spark, sf_dir):
    """No value of a column that only some files of a slice hold is lost; the lineage column is dropped."""
    return load_years(spark, _orders_spec(YEARS[0], YEARS[-1]), stage_mixed_slices(spark, sf_dir))


def sql_union_mixed_slices():
    even_year, odd_key = "year(o_orderdate) % 2 = 0", "o_orderkey % 2 <> 0"
    return (
        "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_totalprice, o_orderdate, "
        f"CASE WHEN {even_year} OR NOT {odd_key} THEN o_orderstatus END AS o_orderstatus, "
        f"CASE WHEN NOT {even_year} OR {odd_key} THEN o_orderpriority END AS o_orderpriority, "
        f"CASE WHEN NOT {even_year} AND {odd_key} THEN month(o_orderdate) > 6 END AS o_late FROM orders"
    )


def q_year_partitions(spark, sf_dir):
    """Years 1996 to 1998 of one dataset with a folder for each year, one of whose years has other types."""
    base = scratch_path(spark, "orders-partitioned")
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    orders.where("year <> 1997").write.partitionBy("year").parquet(f"{base}/orders")
    other = orders.where("year = 1997").withColumn("o_custkey", F.col("o_custkey").cast("int")).drop("year", "o_orderstatus")
    other.write.parquet(f"{base}/orders/year=1997")
    spec = BuildSpec(name="orders", year_min=1996, year_max=1998, path_pattern="{basepath}/orders", output_name="orders", year_column="year")
    return load_years(spark, spec, base)


def sql_year_partitions():
    return (
        "SELECT * REPLACE (CASE WHEN year(o_orderdate) <> 1997 THEN o_orderstatus END AS o_orderstatus), "
        "CAST(year(o_orderdate) AS INTEGER) AS year FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1998"
    )


def q_switch_recovered(spark, sf_dir):
    """Shards under both suffixes after a run that died with its journal written and nothing moved yet:
    the next writer finishes it, then writes one shard more."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.date_format("o_orderdate", "MM").alias("mm"), "o_orderstatus")
    out = scratch_path(spark, "orders-switched")
    write_table(orders, out, "orders", "orders", shard_by="mm")
    some = conflict_aggregate(orders.where("mm IN ('01', '02', '03')"), ["o_custkey", "mm"])
    root = aside(out)
    some.withColumn("mm_shard", F.col("mm")).write.partitionBy("mm_shard").parquet(f"{root}/new")
    names = shard_folders(spark, f"{root}/new", "mm")
    record(spark, out, root, [(f"{root}/new/{n}", f"{out}/orders_array/{n}") for n in names], [f"{out}/orders/{n}" for n in names])
    write_table(orders.where("mm = '03'"), out, "orders", "orders", shard_by="mm")  # flat again
    counted = lambda path, rows: spark.read.parquet(path).groupBy("mm").agg(F.sum(rows).cast("long").alias("n_rows"))
    flat = counted(f"{out}/orders", F.lit(1)).select(F.lit("orders").alias("output"), "mm", "n_rows")
    return flat.union(counted(f"{out}/orders_array", F.size("o_orderstatus")).select(F.lit("orders_array"), "mm", "n_rows"))


def sql_switch_recovered():
    return (
        "SELECT CASE WHEN mm IN ('01', '02') THEN 'orders_array' ELSE 'orders' END AS output, mm, count(*) AS n_rows "
        "FROM (SELECT strftime(o_orderdate, '%m') AS mm FROM orders) GROUP BY mm"
    )


def q_backfill_tables(spark, sf_dir):
    """Two tables over all years, some of whose slices are there: the missing ones are built together."""
    raw, out = stage_order_slices(spark, sf_dir), scratch_path(spark, "orders-tables")
    spec = lambda name, columns: SelectSpec(
        name=name, path_pattern=raw + "/orders_{year}.parquet/*.parquet", output_dir=out, columns=columns
    )
    prices, states = spec("prices", ["o_orderkey", "o_totalprice"]), spec("states", ["o_orderkey", "o_orderstatus", "o_orderdate"])
    backfill_tables(spark, [(prices, [1995, 1999]), (states, [2001])])
    report = backfill_tables(spark, [(prices, YEARS), (states, YEARS[2:])])
    frames = [
        spark.read.parquet(r["path"]).select(*[F.lit(r[c]).alias(c) for c in ("table", "year", "status")], F.substring_index("filename", "/", -2).alias("raw"))
        for r in report
    ]
    counted = reduce(DataFrame.union, frames).groupBy("table", "year", "status", F.substring_index("raw", "/", 1).alias("source"))
    return counted.agg(F.count(F.lit(1)).alias("n_rows"))


def sql_backfill_tables():
    y = "CAST(year(o_orderdate) AS INTEGER)"
    source = "'orders_' || year(o_orderdate) || '.parquet' AS source, count(*) AS n_rows"
    return (
        f"SELECT 'prices' AS \"table\", {y} AS year, CASE WHEN year(o_orderdate) IN (1995, 1999) THEN 'existing' ELSE 'built' END AS status, {source} "
        f"FROM orders GROUP BY ALL UNION ALL SELECT 'states', {y}, CASE WHEN year(o_orderdate) = 2001 THEN 'existing' ELSE 'built' END, {source} "
        "FROM orders WHERE year(o_orderdate) >= 1997 GROUP BY ALL"
    )


def q_incremental_drift(spark, sf_dir):
    """Deliveries whose column types differ, the first file's types holding for all: the streamed table."""
    orders = table(spark, sf_dir, "orders")
    raw, out, ckpt = (scratch_path(spark, f"orders-drift-{n}") for n in ("raw", "out", "ckpt"))
    spec = SelectSpec(name="orders_drift", path_pattern="", columns=["o_orderkey", "year", "price"])
    check_years(orders, "o_orderdate")
    kinds = [("bigint", "double"), ("string", "double"), ("int", "string"), ("bigint", "decimal(12,2)")]

    def deliver(y: int) -> None:
        key, price = kinds[(y - YEARS[0]) % len(kinds)]
        part = year_slice(orders, "o_orderdate", y).select(F.col("o_orderkey").cast(key), F.lit(y).alias("year"), F.col("o_totalprice").cast(price).alias("price"))
        part.write.parquet(f"{raw}/y{y}")

    for batch in (YEARS[:2], YEARS[2:]):
        for y in batch:
            deliver(y)
        run_incremental(spark, spec, raw + "/*/*.parquet", out, checkpoint_location=ckpt)
    return spark.read.parquet(out).select("o_orderkey", "year", "price", F.substring_index(F.substring_index("filename", "/", -2), "/", 1).alias("delivery"))


def sql_incremental_drift():
    y = "year(o_orderdate)"
    price = f"CASE WHEN ({y} - {YEARS[0]}) % 4 = 3 THEN CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) ELSE o_totalprice END"
    return f"SELECT o_orderkey, CAST({y} AS INTEGER) AS year, {price} AS price, 'y' || {y} AS delivery FROM orders"


def q_unpivot_drops_lineage(spark, sf_dir):
    """The monthly unpivot drops the lineage column, under any spelling."""
    wide = _monthly_wide(spark, sf_dir, _mo).withColumn("FileName", F.lit("raw.parquet")).withColumn("region", F.col("o_custkey") % 5)
    return unpivot_monthly(wide)


def sql_unpivot_drops_lineage():
    return _MONTHLY_CTE + "SELECT o_custkey, year, o_custkey % 5 AS region, month, mp AS max_price, coalesce(c, 0) AS n_orders FROM grid"


def q_shard_counts(spark, sf_dir):
    base = stage_order_slices(spark, sf_dir)
    out = scratch_path(spark, "orders-sharded")
    build_table(spark, "orders", _orders_spec(YEARS[0], YEARS[-1], shard_by="year"), base, out)
    return spark.read.parquet(f"{out}/orders").groupBy("year").agg(F.count(F.lit(1)).alias("n_rows"))


def sql_shard_counts():
    return "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n_rows FROM orders GROUP BY 1"


def q_shard_strings(spark, sf_dir):
    """Text shards with leading zeros and rows without a shard, first flat and then aggregated: the
    shard keeps its type, and the flat output's shards are gone."""
    orders = table(spark, sf_dir, "orders")
    month = F.date_format("o_orderdate", "MM")
    src = orders.select("o_custkey", F.nullif(month, F.lit("07")).alias("mm"), "o_orderstatus")
    out = scratch_path(spark, "orders-strings")
    write_table(src, out, "orders", "orders", shard_by="mm")
    write_table(conflict_aggregate(src, ["o_custkey", "mm"]), out, "orders", "orders", shard_by="mm", aggregated=True)
    stale = len(shard_folders(spark, f"{out}/orders", "mm"))
    built = spark.read.parquet(f"{out}/orders_array")
    return built.groupBy("mm", F.expr("typeof(mm)").alias("shard_type")).agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.sum(F.size("o_orderstatus")).alias("n_rows"),
        F.lit(stale).cast("long").alias("stale_shards"),
    )


def sql_shard_strings():
    return (
        "WITH s AS (SELECT o_custkey, nullif(strftime(o_orderdate, '%m'), '07') AS mm FROM orders) "
        "SELECT mm, 'string' AS shard_type, CASE WHEN mm IS NULL THEN count(*) ELSE count(DISTINCT o_custkey) END AS n_keys, "
        "count(*) AS n_rows, CAST(0 AS BIGINT) AS stale_shards FROM s GROUP BY mm"
    )


def q_nested_arrays(spark, sf_dir):
    """Arrays of arrays lose only their outer level; the lineage column stays."""
    li = table(spark, sf_dir, "lineitem")
    pair = F.array(F.array("l_linenumber", F.lit(1)), F.array("l_linenumber", F.lit(2)))
    return explode_periods(li.select("l_orderkey", F.lit("part").alias("filename"), pair.alias("pairs")), n_periods=3)


def sql_nested_arrays():
    return (
        "SELECT l_orderkey, 'part' AS filename, CAST(m AS INTEGER) AS month, "
        "CASE m WHEN 1 THEN [l_linenumber, 1] WHEN 2 THEN [l_linenumber, 2] END AS pairs FROM lineitem, range(1, 4) t(m)"
    )


def q_expression_columns(spark, sf_dir):
    """Entries of a column list may be SQL text; a lineage column listed twice comes once."""
    orders = table(spark, sf_dir, "orders").withColumn("filename", F.lit("f"))
    return select_columns(orders, ["o_orderkey", "CAST(o_totalprice AS BIGINT) AS price", "filename", "upper(o_orderstatus) AS status"])


def sql_expression_columns():
    return "SELECT o_orderkey, CAST(trunc(o_totalprice) AS BIGINT) AS price, upper(o_orderstatus) AS status, 'f' AS filename FROM orders"


def q_row_counts(spark, sf_dir):
    """Rows loaded and written, complete keys, duplicated keys and the largest group, as observed
    during one Stage 2 write."""
    base = stage_order_slices(spark, sf_dir)
    out = scratch_path(spark, "orders-counts")
    res = build_table(spark, "orders", _orders_spec(YEARS[0], YEARS[-1], primary_key=["o_custkey"]), base, out)
    row = (res.stats["rows_loaded"], res.rows, res.stats["n_keys"], res.stats["n_duplicate_keys"], res.stats["max_group_rows"])
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("rows_loaded", "rows_written", "n_keys", "n_duplicate_keys", "max_group_rows")])
    return literal_rows(spark, [row], schema)


def sql_row_counts():
    return (
        "SELECT CAST(sum(n) AS BIGINT) AS rows_loaded, count(*) AS rows_written, count(*) AS n_keys, "
        "count(*) FILTER (WHERE n > 1) AS n_duplicate_keys, max(n) AS max_group_rows "
        "FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey)"
    )


def q_flat_vs_array(spark, sf_dir):
    """The four Stage 2 outcomes on one input: output name and rows of each output."""
    base = stage_order_slices(spark, sf_dir)
    out = scratch_path(spark, "orders-outcomes")
    key = ["o_custkey", "year"]
    outcomes = {
        "aggregated": _orders_spec(YEARS[0], YEARS[-1], primary_key=key),
        "aggregated_sharded": _orders_spec(YEARS[0], YEARS[-1], primary_key=key, shard_by="year"),
        "flat": _orders_spec(YEARS[0], YEARS[-1]),
        "flat_sharded": _orders_spec(YEARS[0], YEARS[-1], shard_by="year"),
    }
    frames = []
    for label, spec in outcomes.items():
        target = f"{out}/{label}"
        build_table(spark, "orders", spec, base, target)
        if spec.shard_by:
            name = "orders_array" if spec.aggregated else "orders"
            df = spark.read.parquet(f"{target}/{name}")
            frames.append(
                df.groupBy("year_shard").agg(F.count(F.lit(1)).alias("n_rows")).select(
                    F.lit(label).alias("outcome"),
                    F.concat(F.lit(f"{name}/year_shard="), F.col("year_shard").cast("string")).alias("output"),
                    "n_rows",
                )
            )
        else:
            name = spec.formatted_output_name() + ("_array" if spec.aggregated else "") + ".parquet"
            df = spark.read.parquet(f"{target}/{name}")
            frames.append(df.select(F.lit(label).alias("outcome"), F.lit(name).alias("output"), F.lit(1).alias("_one"))
                          .groupBy("outcome", "output").agg(F.count(F.lit(1)).alias("n_rows")))
    res = frames[0]
    for f in frames[1:]:
        res = res.unionByName(f)
    return res


def sql_flat_vs_array():
    y = "CAST(year(o_orderdate) AS INTEGER)"
    return (
        f"SELECT 'aggregated' AS outcome, 'orders_1995_2001_array.parquet' AS output, count(*) AS n_rows "
        f"FROM (SELECT DISTINCT o_custkey, {y} FROM orders) "
        f"UNION ALL SELECT 'aggregated_sharded', 'orders_array/year_shard=' || CAST(yr AS VARCHAR), count(*) "
        f"FROM (SELECT DISTINCT o_custkey, {y} AS yr FROM orders) GROUP BY yr "
        f"UNION ALL SELECT 'flat', 'orders_1995_2001.parquet', count(*) FROM orders "
        f"UNION ALL SELECT 'flat_sharded', 'orders/year_shard=' || CAST({y} AS VARCHAR), count(*) FROM orders GROUP BY {y}"
    )


BACKFILL_PRESENT = [1995, 1996, 1997]


def q_backfill(spark, sf_dir):
    """Years 1995-1997 built first; a backfill over 1995-2001 builds only the rest."""
    raw = stage_order_slices(spark, sf_dir)
    out = scratch_path(spark, "orders-stage1")
    spec = SelectSpec(
        name="orders",
        path_pattern=raw + "/orders_{year}.parquet/*.parquet",
        output_dir=out,
        columns=["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"],
    )
    backfill(spark, spec, BACKFILL_PRESENT)
    report = backfill(spark, spec, YEARS)
    frames = [
        spark.read.parquet(r["path"]).select(F.lit(r["year"]).alias("year"), F.lit(r["status"]).alias("status"))
        for r in report
    ]
    res = frames[0]
    for f in frames[1:]:
        res = res.union(f)
    return res.groupBy("year", "status").agg(F.count(F.lit(1)).alias("n_rows"))


def sql_backfill():
    present = ", ".join(str(y) for y in BACKFILL_PRESENT)
    return (
        "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, "
        f"CASE WHEN year(o_orderdate) IN ({present}) THEN 'existing' ELSE 'built' END AS status, "
        "count(*) AS n_rows FROM orders GROUP BY ALL"
    )


def q_incremental_select(spark, sf_dir):
    """Raw monthly-array files arrive in two deliveries (1995-1998, then 1999-2001); each
    incremental run explodes only the files it has not seen."""
    orders = table(spark, sf_dir, "orders")
    check_years(orders, "o_orderdate")
    raw, out = scratch_path(spark, "orders-raw"), scratch_path(spark, "orders-incremental")
    ckpt = scratch_path(spark, "orders-incremental-ckpt")
    spec = SelectSpec(name="orders_amt", path_pattern="", columns=["o_orderkey", "year", "amt"], explode_arrays=True)

    def deliver(years: list[int]) -> None:
        for y in years:
            part = year_slice(orders, "o_orderdate", y).select(
                "o_orderkey",
                F.lit(y).alias("year"),
                F.array(*[F.when(F.month("o_orderdate") == m, F.col("o_totalprice")) for m in range(1, 13)]).alias("amt"),
            )
            write_parquet(part, f"{raw}/y{y}")

    deliver(YEARS[:4])
    run_incremental(spark, spec, raw + "/*/*.parquet", out, checkpoint_location=ckpt)
    deliver(YEARS[4:])
    run_incremental(spark, spec, raw + "/*/*.parquet", out, checkpoint_location=ckpt)
    return spark.read.parquet(out).select("o_orderkey", "year", "month", "amt")


def sql_incremental_select():
    return (
        "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(p AS INTEGER) AS month, "
        "CASE WHEN month(o_orderdate) = p THEN o_totalprice END AS amt "
        "FROM orders CROSS JOIN range(1, 13) t(p)"
    )


def q_stage1_to_stage2(spark, sf_dir):
    """lineitem delivered as one raw extract per ship year -> Stage 1 per year (projection and
    lineage) -> Stage 2 (years by name, one row per line key and year, sharded by year) -> per
    shard: keys, source rows, keys whose quantity conflicts."""
    li = table(spark, sf_dir, "lineitem")
    check_years(li, "l_shipdate")
    raw, inter, out = (scratch_path(spark, n) for n in ("lineitem-raw", "lineitem-inter", "lineitem-out"))

    # one scan for all extracts; each year's folder is a raw extract of its own
    year = F.year("l_shipdate")
    li.withColumns({"year": year, "extract": year}).write.partitionBy("extract").parquet(raw)
    select = SelectSpec(
        name="lineitem",
        path_pattern=raw + "/extract={year}/*.parquet",
        output_dir=inter,
        columns=["l_orderkey", "l_linenumber", "year", "l_quantity", "l_returnflag", "l_shipdate"],
    )
    backfill(spark, select, YEARS)
    build = BuildSpec(
        name="lineitem",
        year_min=YEARS[0],
        year_max=YEARS[-1],
        path_pattern="{basepath}/lineitem_{year}.parquet",
        output_name="lineitem_{year_min}_{year_max}",
        primary_key=["l_orderkey", "l_linenumber", "year"],
        shard_by="year",
    )
    build_table(spark, "lineitem", build, inter, out)
    built = spark.read.parquet(f"{out}/lineitem_array")
    return built.groupBy("year").agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.sum(F.size("l_quantity")).alias("n_rows"),
        F.sum(F.when(F.col("n_distinct_l_quantity") > 1, 1).otherwise(0)).alias("n_conflicting_keys"),
    )


def sql_stage1_to_stage2():
    return (
        "WITH s AS (SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS INTEGER) AS year, l_quantity FROM lineitem), "
        "g AS (SELECT year, l_orderkey, l_linenumber, count(*) AS n, count(DISTINCT l_quantity) AS nd FROM s GROUP BY ALL) "
        "SELECT year, count(*) AS n_keys, CAST(sum(n) AS BIGINT) AS n_rows, "
        "CAST(count(*) FILTER (WHERE nd > 1) AS BIGINT) AS n_conflicting_keys FROM g GROUP BY year"
    )


# ---------------------------------------------------------------------------------------------
# quality checks

EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def _events_with_nulls(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.withColumn("event_type", F.nullif(F.col("event_type"), F.lit("error")))


def q_qc_null_counts(spark, sf_dir):
    return null_counts(_events_with_nulls(spark, sf_dir))


def sql_qc_null_counts():
    src = "(SELECT * REPLACE (nullif(event_type, 'error') AS event_type) FROM events)"
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM {src}" for c in EVENT_COLUMNS
    )


def q_qc_key_uniqueness(spark, sf_dir):
    return key_uniqueness(_lineitem_null_linenumber(spark, sf_dir), LINEITEM_PK)


def sql_qc_key_uniqueness():
    return (
        "WITH s AS (SELECT l_orderkey, nullif(l_linenumber, 3) AS l_linenumber FROM lineitem), "
        "d AS (SELECT count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM s)) "
        "SELECT (SELECT count(*) FROM s) AS row_count, d.n AS distinct_pk_count, "
        "(SELECT count(*) FROM s) - d.n AS duplicate_count FROM d"
    )


def q_qc_row_uniqueness(spark, sf_dir):
    return row_uniqueness(table(spark, sf_dir, "events"), ignore=("event_id", "ts"))


def sql_qc_row_uniqueness():
    return (
        "WITH d AS (SELECT count(*) AS n FROM (SELECT DISTINCT user_id, event_type, value, props FROM events)) "
        "SELECT (SELECT count(*) FROM events) AS row_count, d.n AS distinct_row_count, "
        "(SELECT count(*) FROM events) - d.n AS duplicate_count FROM d"
    )


LINEITEM_COLUMNS = LINEITEM_PK[:1] + LINEITEM_VALUES[:2] + LINEITEM_PK[1:] + LINEITEM_VALUES[2:]


# a table spec expecting two columns the customer extract does not have
CUSTOMER_EXPECTED = ["c_custkey", "c_name", "c_phone", "c_nationkey", "c_address", "c_acctbal", "C_MKTSEGMENT"]


def q_qc_missing_columns(spark, sf_dir):
    return expected_columns_report(table(spark, sf_dir, "customer"), CUSTOMER_EXPECTED)


def sql_qc_missing_columns():
    have = {"c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"}
    parts = [
        f"SELECT '{c}' AS column_name, true AS present, count({c}) AS n_non_null FROM customer"
        if c.lower() in have
        else f"SELECT '{c}' AS column_name, false AS present, CAST(0 AS BIGINT) AS n_non_null"
        for c in CUSTOMER_EXPECTED
    ]
    return " UNION ALL ".join(parts)


def q_qc_sample(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return sample_rows(li, 100, order_by=LINEITEM_COLUMNS)


def sql_qc_sample():
    return f"SELECT * FROM lineitem ORDER BY {_order_by(LINEITEM_COLUMNS)} LIMIT 100"


def q_run_qc(spark, sf_dir):
    """The counts of ``run_qc`` on a written table with a key, NULLs and an expected column that is
    missing, next to its status."""
    out = scratch_path(spark, "qc")
    path = f"{out}/events.parquet"
    write_parquet(_events_with_nulls(spark, sf_dir), path)
    spec = SelectSpec(name="events", path_pattern=f"{path}/*.parquet", columns=EVENT_COLUMNS + ["absent"], primary_key=["user_id"])
    qc = run_qc(spark, spec, path, 2024, qc_dir=f"{out}/events.qc")
    row = (qc["status"], qc["row_count"], qc["n_columns"], qc["null_counts"]["event_type"], qc["distinct_pk_count"], qc["duplicate_count"], len(qc["warnings"]))
    names = ["status", "row_count", "n_columns", "null_event_types", "distinct_pk_count", "duplicate_count", "n_warnings"]
    schema = T.StructType([T.StructField(n, T.StringType() if n == "status" else T.LongType()) for n in names])
    return literal_rows(spark, [row], schema)


def sql_run_qc():
    return (
        "SELECT 'warn' AS status, count(*) AS row_count, CAST(6 AS BIGINT) AS n_columns, count(*) FILTER (WHERE event_type = 'error') AS null_event_types, "
        "CAST(count(DISTINCT user_id) + max(CASE WHEN user_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS distinct_pk_count, "
        "CAST(count(*) - count(DISTINCT user_id) - max(CASE WHEN user_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS duplicate_count, CAST(2 AS BIGINT) AS n_warnings FROM events"
    )


def q_qc_profile_files(spark, sf_dir):
    """Rows and NULLs of a written table from its files' footers; its array column needs a scan, and one
    column stands in half of the files only."""
    path = f"{scratch_path(spark, 'qc-profile')}/events.parquet"
    events = _events_with_nulls(spark, sf_dir).withColumn("tags", F.when(F.col("user_id") % 3 == 0, F.array("event_type")))
    events.where("event_id % 2 = 0").write.parquet(path)
    events.where("event_id % 2 <> 0").drop("props").write.mode("append").parquet(path)
    return profile_files(spark, path)


def sql_qc_profile_files():
    src = "(SELECT * REPLACE (nullif(event_type, 'error') AS event_type, CASE WHEN event_id % 2 = 0 THEN props END AS props) FROM events)"
    parts = ["SELECT 'row_count' AS \"check\", CAST(NULL AS VARCHAR) AS column_name, count(*) AS value FROM events"]
    parts += [f"SELECT 'null_count', '{c}', count(*) - count({c}) FROM {src}" for c in EVENT_COLUMNS]
    parts.append("SELECT 'null_count', 'tags', count(*) FILTER (WHERE user_id IS NULL OR user_id % 3 <> 0) FROM events")
    return " UNION ALL ".join(parts)


def q_qc_artefacts(spark, sf_dir):
    """What the QC files of three runs hold: a sound table, one without raw input, one that is missing."""
    base = scratch_path(spark, "qc-files")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    write_parquet(customers, f"{base}/raw/customer.parquet")
    select = SelectSpec(name="customer", path_pattern=f"{base}/raw/customer.parquet", columns=["c_custkey", "c_acctbal"], output_dir=base, output_name="customer", primary_key=["c_custkey"])
    path = process_year(spark, select, 2024).path
    lost = SelectSpec(name="customer", path_pattern=f"{base}/none/*.parquet", columns=["c_custkey", "c_acctbal"], primary_key=["c_custkey"])
    run_qc(spark, select, path, 2024, qc_dir=f"{base}/sound.qc", sample_n=10, sample_order=["c_custkey"])
    run_qc(spark, lost, path, 2024, qc_dir=f"{base}/no_raw.qc", sample_n=5, sample_hash=["c_custkey"])
    run_qc(spark, select, f"{base}/absent.parquet", 2024, qc_dir=f"{base}/absent.qc")
    facts = []
    for run in ("sound", "no_raw", "absent"):
        report, before, after = ({} if not text else json.loads(text) for text in (_text(spark, f"{base}/{run}.qc/{n}.json") for n in ("qc", "schema_before", "schema_after")))
        sample = spark.read.parquet(f"{base}/{run}.qc/sample.parquet") if report["status"] != "error" else None
        facts.append((run, report["status"], report.get("row_count"), report.get("duplicate_count"), len(report["warnings"]), len(report["errors"]), ",".join(before), ",".join(after), None if sample is None else sample.agg(F.sum("c_custkey")).first()[0], None if sample is None else sample.count()))
    names = ["run", "status", "row_count", "duplicate_count", "n_warnings", "n_errors", "before", "after", "sample_keys", "sample_rows"]
    schema = T.StructType([T.StructField(n, T.StringType() if n in ("run", "status", "before", "after") else T.LongType()) for n in names])
    return literal_rows(spark, facts, schema)


def _text(spark, path: str) -> str:
    return hadoop_fs.read_text(spark, path) if hadoop_fs.exists(spark, path) else ""


def sql_qc_artefacts():
    key = "'{\"c_custkey\":' || c_custkey || '}'"
    first = "(SELECT CAST(sum(c_custkey) AS BIGINT) FROM (SELECT c_custkey FROM customer ORDER BY c_custkey LIMIT 10))"
    spread = f"(SELECT CAST(sum(c_custkey) AS BIGINT) FROM (SELECT c_custkey FROM customer ORDER BY md5({key}) LIMIT 5))"
    zero, one = "CAST(0 AS BIGINT)", "CAST(1 AS BIGINT)"
    after = "'c_custkey,c_acctbal,filename' AS after"
    return (
        f"SELECT 'sound' AS run, 'ok' AS status, count(*) AS row_count, {zero} AS duplicate_count, {zero} AS n_warnings, {zero} AS n_errors, "
        f"'c_custkey,c_nationkey,c_acctbal' AS before, {after}, {first} AS sample_keys, CAST(10 AS BIGINT) AS sample_rows FROM customer "
        f"UNION ALL SELECT 'no_raw', 'ok', count(*), {zero}, {one}, {zero}, '', {after}, {spread}, CAST(5 AS BIGINT) FROM customer "
        f"UNION ALL SELECT 'absent', 'error', NULL, NULL, {zero}, {one}, 'c_custkey,c_nationkey,c_acctbal', '', NULL, NULL"
    )


def q_qc_hash_sample(spark, sf_dir):
    return sample_rows(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), 100, hash_of=["o_orderkey"])


def sql_qc_hash_sample():
    return "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY md5('{\"o_orderkey\":' || o_orderkey || '}') LIMIT 100"


QC_YEARS = list(range(1995, 2003))  # 2002 has no rows: reported as a warning


def q_qc_report(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").withColumn("year", F.year("l_shipdate"))
    return qc_report(li, "year", years=QC_YEARS, primary_key=LINEITEM_PK)


def sql_qc_report():
    src = "(SELECT *, CAST(year(l_shipdate) AS INTEGER) AS year FROM lineitem)"
    parts = [f"SELECT year, 'row_count' AS \"check\", CAST(NULL AS VARCHAR) AS column_name, count(*) AS value FROM {src} GROUP BY year"]
    parts += [
        f"SELECT year, 'null_count', '{c}', count(*) - count({c}) FROM {src} GROUP BY year" for c in LINEITEM_COLUMNS
    ]
    parts += [
        f"SELECT year, 'distinct_pk_count', NULL, count(*) FROM (SELECT DISTINCT year, l_orderkey, l_linenumber FROM {src}) GROUP BY year",
        f"SELECT year, 'duplicate_count', NULL, count(*) - count(DISTINCT (l_orderkey, l_linenumber)) FROM {src} GROUP BY year",
    ]
    absent = ", ".join(f"({y})" for y in QC_YEARS)
    missing = f"(SELECT CAST(y AS INTEGER) AS year FROM (VALUES {absent}) v(y) WHERE y NOT IN (SELECT year FROM {src}))"
    parts.append(f"SELECT year, 'row_count', NULL, 0 FROM {missing}")
    parts += [f"SELECT year, 'null_count', '{c}', 0 FROM {missing}" for c in LINEITEM_COLUMNS]
    parts += [f"SELECT year, '{k}', NULL, 0 FROM {missing}" for k in ("distinct_pk_count", "duplicate_count")]
    body = " UNION ALL ".join(parts)
    return (
        f"WITH r AS ({body}) SELECT year, \"check\", column_name, value, "
        "CASE WHEN \"check\" = 'row_count' AND value = 0 THEN 'warn' "
        "WHEN \"check\" = 'duplicate_count' AND value > 0 THEN 'warn' ELSE 'ok' END AS status FROM r"
    )


# ---------------------------------------------------------------------------------------------
# registry


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "conflict_aggregate": q_conflict_aggregate,
        "conflict_null_key": q_conflict_null_key,
        "conflict_array_column": q_conflict_array_column,
        "duplicate_keys": q_duplicate_keys,
        "nest_children": q_nest_children,
        "conflict_summary": q_conflict_summary,
        "conflict_hot_key": q_conflict_hot_key,
        "duplicate_key_counts": q_duplicate_key_counts,
        "explode_periods": q_explode_periods,
        "explode_ragged_arrays": q_explode_ragged_arrays,
        "unpivot_monthly": q_unpivot_monthly,
        "unpivot_sparse": q_unpivot_sparse,
        "unpivot_custom_pattern": q_unpivot_custom_pattern,
        "select_with_lineage": q_select_with_lineage,
        "union_by_name": q_union_by_name,
        "year_range": q_year_range,
        "schema_drift": q_schema_drift,
        "shard_counts": q_shard_counts,
        "shard_strings": q_shard_strings,
        "nested_arrays": q_nested_arrays,
        "expression_columns": q_expression_columns,
        "row_counts": q_row_counts,
        "flat_vs_array": q_flat_vs_array,
        "backfill": q_backfill,
        "incremental_select": q_incremental_select,
        "stage1_to_stage2": q_stage1_to_stage2,
        "qc_null_counts": q_qc_null_counts,
        "qc_key_uniqueness": q_qc_key_uniqueness,
        "qc_row_uniqueness": q_qc_row_uniqueness,
        "qc_report": q_qc_report,
        "qc_missing_columns": q_qc_missing_columns,
        "run_qc": q_run_qc,
        "qc_sample": q_qc_sample,
        "union_mixed_slices": q_union_mixed_slices,
        "year_partitions": q_year_partitions,
        "switch_recovered": q_switch_recovered,
        "backfill_tables": q_backfill_tables,
        "incremental_drift": q_incremental_drift,
        "unpivot_drops_lineage": q_unpivot_drops_lineage,
        "qc_profile_files": q_qc_profile_files,
        "qc_artefacts": q_qc_artefacts,
        "qc_hash_sample": q_qc_hash_sample,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "conflict_aggregate": sql_conflict_aggregate(),
        "conflict_null_key": sql_conflict_null_key(),
        "conflict_array_column": sql_conflict_array_column(),
        "duplicate_keys": sql_duplicate_keys(),
        "nest_children": sql_nest_children(),
        "conflict_summary": sql_conflict_summary(),
        "conflict_hot_key": sql_conflict_hot_key(),
        "duplicate_key_counts": sql_duplicate_key_counts(),
        "explode_periods": sql_explode_periods(),
        "explode_ragged_arrays": sql_explode_ragged_arrays(),
        "unpivot_monthly": sql_unpivot_monthly(),
        "unpivot_sparse": sql_unpivot_sparse(),
        "unpivot_custom_pattern": sql_unpivot_custom_pattern(),
        "select_with_lineage": sql_select_with_lineage(),
        "union_by_name": sql_union_by_name(),
        "year_range": sql_year_range(),
        "schema_drift": sql_schema_drift(),
        "shard_counts": sql_shard_counts(),
        "shard_strings": sql_shard_strings(),
        "nested_arrays": sql_nested_arrays(),
        "expression_columns": sql_expression_columns(),
        "row_counts": sql_row_counts(),
        "flat_vs_array": sql_flat_vs_array(),
        "backfill": sql_backfill(),
        "incremental_select": sql_incremental_select(),
        "stage1_to_stage2": sql_stage1_to_stage2(),
        "qc_null_counts": sql_qc_null_counts(),
        "qc_key_uniqueness": sql_qc_key_uniqueness(),
        "qc_row_uniqueness": sql_qc_row_uniqueness(),
        "qc_report": sql_qc_report(),
        "qc_missing_columns": sql_qc_missing_columns(),
        "run_qc": sql_run_qc(),
        "qc_sample": sql_qc_sample(),
        "union_mixed_slices": sql_union_mixed_slices(),
        "year_partitions": sql_year_partitions(),
        "switch_recovered": sql_switch_recovered(),
        "backfill_tables": sql_backfill_tables(),
        "incremental_drift": sql_incremental_drift(),
        "unpivot_drops_lineage": sql_unpivot_drops_lineage(),
        "qc_profile_files": sql_qc_profile_files(),
        "qc_artefacts": sql_qc_artefacts(),
        "qc_hash_sample": sql_qc_hash_sample(),
    }
