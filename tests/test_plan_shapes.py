"""Scale-relevant plan properties, pinned so they cannot regress silently."""

from pyspark.sql import functions as F

from conftest import SF_SMALL, jobs
from panelforge.operators.conflict import conflict_aggregate
from panelforge.plans.qc import qc_report


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _executed(df) -> str:
    """The plan that ran, as adaptive execution left it."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[0]


def test_cold_keys_are_shuffled_once(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    for hot_keys in (None, 100):  # without hot keys the sketch's branch and joins are gone
        plan = _executed(conflict_aggregate(li, ["l_orderkey", "l_linenumber"], hot_keys=hot_keys))
        assert plan.count("Exchange hashpartitioning") == 1
        assert not any(x in plan for x in ("Expand", "Join", "Python"))


def test_hot_keys_are_dealt_over_pieces_and_only_their_number_is_broadcast(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    src = li.withColumn("l_orderkey", F.when(F.col("l_linenumber") <= 2, F.lit(0)).otherwise(F.col("l_orderkey")))
    with jobs(spark) as planning:
        df = conflict_aggregate(src, ["l_orderkey"], hot_rows=1000, hot_keys=100)
    assert planning.n == 0  # nothing runs before the plan does
    plan = _executed(df)
    assert plan.count("Exchange hashpartitioning") == 3  # cold keys; pieces, then hot keys
    assert plan.count("BroadcastHashJoin") == 2 and "Expand" not in plan and "Python" not in plan


def test_build_table_pushes_the_key_filters_to_the_scan(spark, tmp_path):
    from panelforge.plans.stage2 import build_table_df
    from panelforge.session import observation

    src = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_custkey", "o_orderstatus")
    src.write.parquet(str(tmp_path / "orders_1"))
    conf = {"year_min": 1, "year_max": 1, "path_pattern": "{basepath}/orders_{year}", "output_name": "o", "primary_key": ["o_custkey"]}
    plan = build_table_df(spark, "orders", conf, str(tmp_path), loaded=observation("t"))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_custkey)]" in plan and "PushedFilters: [IsNull(o_custkey)]" in plan


def test_sharded_write_makes_few_files(spark, tmp_path):
    import glob

    from panelforge.sinks.parquet import write_sharded

    df = spark.range(2000).repartition(40).select("id", (F.col("id") % 7).alias("s"))
    write_sharded(df, str(tmp_path / "t"), "s")
    assert len(glob.glob(f"{tmp_path}/t/*/part-*")) <= 14


def test_qc_report_aggregates_once_per_measure(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").withColumn("year", F.year("l_shipdate"))
    plan = _plan(qc_report(li, "year", years=list(range(1995, 2003)), primary_key=["l_orderkey", "l_linenumber"]))
    assert plan.count("FileScan") == 2  # one scan for the profile, one for key uniqueness
