import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from panelforge.plans.backfill import backfill, backfill_tables
from panelforge.plans.qc import qc_report, run_qc
from panelforge.plans.stage1 import process_year, select_year
from panelforge.plans.stage2 import build_table
from panelforge.sinks.parquet import write_table
from panelforge.specs import BuildSpec, SelectSpec


def test_w1_null_shard_goes_to_default_partition(spark, tmp_path):
    df = spark.createDataFrame([(1, 2000), (2, None)], "id int, year int")
    res = write_table(df, str(tmp_path), "t", "t_all", shard_by="year")
    assert res.null_shard_rows == 1 and res.warnings
    shards = sorted(p for p in os.listdir(tmp_path / "t") if p.startswith("year_shard="))
    assert shards == ["year_shard=2000", "year_shard=__HIVE_DEFAULT_PARTITION__"]


def test_w2_rerun_replaces_only_written_shards(spark, tmp_path):
    df = spark.createDataFrame([(1, 2000), (2, 2001)], "id int, year int")
    write_table(df, str(tmp_path), "t", "t_all", shard_by="year")
    write_table(spark.createDataFrame([(9, 2001)], "id int, year int"), str(tmp_path), "t", "t_all", shard_by="year")
    back = sorted((r["id"], r["year"]) for r in rows(spark.read.parquet(str(tmp_path / "t"))))
    assert back == [(1, 2000), (9, 2001)]


def test_suffix_switch_removes_stale_shard(spark, tmp_path):
    df = spark.createDataFrame([(1, 2000), (2, 2001)], "id int, year int")
    write_table(df, str(tmp_path), "t", "t_all", shard_by="year", aggregated=False)
    write_table(df.where("year = 2001"), str(tmp_path), "t", "t_all", shard_by="year", aggregated=True)
    assert sorted(p for p in os.listdir(tmp_path / "t") if p.startswith("year_shard=")) == ["year_shard=2000"]
    assert sorted(p for p in os.listdir(tmp_path / "t_array") if p.startswith("year_shard=")) == ["year_shard=2001"]


def test_v1_validation():
    with pytest.raises(ValueError, match="no part of its key"):
        BuildSpec.from_dict("t", {"year_min": 1, "year_max": 2, "path_pattern": "x", "output_name": "y", "primary_key": ["a"], "shard_by": "b"})
    with pytest.raises(ValueError, match="output_name, year_max"):
        BuildSpec.from_dict("t", {"year_min": 1, "path_pattern": "x"})


def _stage_raw(spark, tmp_path):
    """Raw monthly extracts for two years, built from the small orders table."""
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    raw = str(tmp_path / "raw")
    for y in (1996, 1997):
        part = o.where(F.year("o_orderdate") == y).select(
            F.col("o_custkey").alias("person_id"),
            F.lit(y).alias("year"),
            F.array(*[F.when(F.month("o_orderdate") == m, F.col("o_orderstatus")) for m in range(1, 13)]).alias("status"),
            *[F.when(F.month("o_orderdate") == m, F.col("o_totalprice")).alias(f"amt_mo_{m:02d}") for m in range(1, 13)],
        )
        part.repartition(2).write.parquet(f"{raw}/{y}")
    return raw


def test_stage1_stage2_qc_end_to_end(spark, tmp_path):
    raw = _stage_raw(spark, tmp_path)
    inter = str(tmp_path / "inter")
    cols = ["person_id", "year", "status"]
    spec = SelectSpec(name="enrol", path_pattern=raw + "/{year}/*.parquet", output_dir=inter, columns=cols,
                      explode_arrays=True, output_name="enrol_{year}", primary_key=["person_id", "year", "month"])
    for y in (1996, 1997):
        res = process_year(spark, spec, y)
        n_in = spark.read.parquet(f"{raw}/{y}").count()
        assert res.rows == n_in * 12
    df = spark.read.parquet(f"{inter}/enrol_1996.parquet")
    assert df.columns == ["person_id", "year", "filename", "month", "status"]

    conf = {"year_min": 1996, "year_max": 1997, "path_pattern": "{basepath}/enrol_{year}.parquet",
            "output_name": "enrol_{year_min}_{year_max}", "primary_key": ["person_id", "year", "month"], "shard_by": "year"}
    out = str(tmp_path / "out")
    res = build_table(spark, "enrol", conf, inter, out)
    built = spark.read.parquet(f"{out}/enrol_array")
    assert sorted(res.shards) == ["1996", "1997"]
    n_loaded = spark.read.parquet(f"{inter}/enrol_*.parquet").count()
    assert res.stats["rows_loaded"] == n_loaded and res.stats["n_keys"] == res.rows
    assert res.stats["n_duplicate_keys"] > 0 and res.stats["max_group_rows"] > 1
    assert "filename" not in built.columns
    assert built.select(F.sum(F.size("status"))).first()[0] == spark.read.parquet(f"{inter}/enrol_*.parquet").count()

    qc = run_qc(spark, spec, f"{inter}/enrol_1996.parquet", 1996, qc_dir=str(tmp_path / "qc"))
    assert qc["status"] == "warn" and qc["duplicate_count"] > 0  # customers with several orders per year
    assert qc["row_count"] == df.count() and qc["null_counts"]["status"] > 0
    assert not any("lacks columns" in w for w in qc["warnings"])
    for f in ("qc.json", "schema_before.json", "schema_after.json", "sample.parquet"):
        assert os.path.exists(tmp_path / "qc" / f)
    assert json.load(open(tmp_path / "qc" / "qc.json"))["table"] == "enrol"


def test_q3_unpivot_no_missing_column_warning(spark, tmp_path):
    raw = _stage_raw(spark, tmp_path)
    inter = str(tmp_path / "inter")
    spec = SelectSpec(name="amt", path_pattern=raw + "/{year}/*.parquet", output_dir=inter,
                      columns=["person_id", "year"] + [f"amt_mo_{m:02d}" for m in range(1, 13)], monthly_columns=True)
    process_year(spark, spec, 1996)
    out = spark.read.parquet(spec.output_path(1996))
    assert out.columns == ["person_id", "year", "month", "amt"]
    qc = run_qc(spark, spec, spec.output_path(1996), 1996, qc_dir=str(tmp_path / "qc2"))
    assert not any("lacks columns" in w for w in qc["warnings"])


def test_q1_zero_rows_is_warn(spark, tmp_path):
    p = str(tmp_path / "empty.parquet")
    spark.createDataFrame([], "id int, v string").write.parquet(p)
    spec = SelectSpec(name="e", path_pattern=str(tmp_path / "nothing*"), columns=["id", "v"])
    qc = run_qc(spark, spec, p, 2000, qc_dir=str(tmp_path / "qc"))
    assert qc["status"] == "warn" and qc["row_count"] == 0 and qc["null_counts"] == {"id": 0, "v": 0}
    assert any("schema_before" in w for w in qc["warnings"])


def test_q2_null_keys_count_as_values(spark, tmp_path):
    p = str(tmp_path / "k.parquet")
    spark.createDataFrame([(None,), (None,), (1,)], "k int").write.parquet(p)
    spec = SelectSpec(name="k", path_pattern=p, columns=["k"], primary_key=["k"])
    qc = run_qc(spark, spec, p, 2000, qc_dir=str(tmp_path / "qc"))
    assert qc["distinct_pk_count"] == 2 and qc["duplicate_count"] == 1 and qc["status"] == "warn"


def test_missing_output_is_error(spark, tmp_path):
    spec = SelectSpec(name="k", path_pattern="x", columns=["k"])
    qc = run_qc(spark, spec, str(tmp_path / "nope.parquet"), 2000, qc_dir=str(tmp_path / "qc"))
    assert qc["status"] == "error" and qc["errors"]


def test_qc_report_multi_year(spark):
    df = spark.createDataFrame([(1, 2000), (1, 2000), (2, 2001)], "k int, year int")
    rep = {(r["year"], r["check"], r["column_name"]): (r["value"], r["status"]) for r in rows(qc_report(df, "year", [2000, 2001, 2002], ["k"]))}
    assert rep[(2000, "duplicate_count", None)] == (1, "warn")
    assert rep[(2001, "duplicate_count", None)] == (0, "ok")
    assert rep[(2002, "row_count", None)] == (0, "warn")


def test_backfill_builds_only_missing(spark, tmp_path):
    raw = _stage_raw(spark, tmp_path)
    spec = SelectSpec(name="b", path_pattern=raw + "/{year}/*.parquet", output_dir=str(tmp_path / "o"), columns=["person_id", "year"])
    first = backfill(spark, spec, [1996])
    second = backfill(spark, spec, [1996, 1997])
    assert [r["status"] for r in first] == ["built"]
    assert [r["status"] for r in second] == ["existing", "built"]


def test_select_year_explode_wins(spark, tmp_path):
    raw = _stage_raw(spark, tmp_path)
    spec = SelectSpec(name="x", path_pattern=raw + "/1996/*.parquet", columns=["person_id", "status", "amt_mo_01"],
                      explode_arrays=True, monthly_columns=True)
    assert select_year(spark, spec).columns == ["person_id", "amt_mo_01", "filename", "month", "status"]


def test_concurrent_writes_observe_their_own_counts(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from panelforge.sinks.parquet import write_parquet

    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    parts = {n: li.where(F.col("l_linenumber") == n) for n in range(1, 7)}
    want = {n: df.count() for n, df in parts.items()}
    with ThreadPoolExecutor(6) as pool:
        got = dict(zip(parts, pool.map(lambda n: write_parquet(parts[n], str(tmp_path / f"p{n}")).rows, parts)))
    assert got == want


def test_qc_report_on_empty_table(spark):
    df = spark.createDataFrame([], "k int, year int")
    rep = {(r["year"], r["check"], r["column_name"]): (r["value"], r["status"]) for r in rows(qc_report(df, "year", [2000], ["k"]))}
    assert rep[(2000, "row_count", None)] == (0, "warn")
    assert rep[(2000, "null_count", "k")] == (0, "ok")
    assert rep[(2000, "duplicate_count", None)] == (0, "ok")


def test_backfill_of_several_tables(spark, tmp_path):
    raw = _stage_raw(spark, tmp_path)

    def spec(name):
        return SelectSpec(name=name, path_pattern=raw + "/{year}/*.parquet", output_dir=str(tmp_path / "inter"),
                          columns=["person_id", "year"], output_name=name + "_{year}")

    first = backfill_tables(spark, [(spec("a"), [1996])])
    both = backfill_tables(spark, [(spec("a"), [1996, 1997]), (spec("b"), [1997])])
    assert [r["status"] for r in first] == ["built"]
    assert [(r["table"], r["year"], r["status"]) for r in both] == [("a", 1996, "existing"), ("a", 1997, "built"), ("b", 1997, "built")]
    with pytest.raises(ValueError, match="several wanted tables"):
        backfill_tables(spark, [(spec("a"), [1996]), (spec("a"), [1996])])


def test_incremental_refuses_a_file_that_lacks_a_column(spark, tmp_path):
    from panelforge.streaming import run_incremental

    spark.createDataFrame([(1, 2)], "a int, b int").coalesce(1).write.parquet(str(tmp_path / "raw" / "x1"))
    spark.createDataFrame([(1,)], "a int").coalesce(1).write.parquet(str(tmp_path / "raw" / "x2"))
    spec = SelectSpec(name="t", path_pattern="", columns=["a"])
    with pytest.raises(Exception, match="missing"):
        run_incremental(spark, spec, str(tmp_path / "raw" / "*" / "*.parquet"), str(tmp_path / "out"), checkpoint_location=str(tmp_path / "ckpt"))
    assert not (tmp_path / "out").exists()
