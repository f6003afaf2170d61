"""Runs over years: backfill as one plan, year-partitioned inputs, samples that don't depend on the layout."""

import json
import os

import pytest

from conftest import jobs
from panelforge.operators.quality import sample_rows
from panelforge.plans.backfill import backfill, backfill_tables
from panelforge.plans.stage2 import build_table_df, load_years
from panelforge.specs import BuildSpec, SelectSpec


@pytest.fixture
def tables(spark, tmp_path):
    for year in range(2001, 2006):
        spark.range(year - 2000).selectExpr("id", f"{year} AS year", "CAST(id AS STRING) AS s").write.parquet(f"{tmp_path}/raw/a/{year}")
        spark.range(10 if year != 2003 else 0).selectExpr("id", f"{year} AS year", "id * 2 AS v").write.parquet(f"{tmp_path}/raw/b/{year}")
    spec = lambda name, columns: SelectSpec(name=name, path_pattern=f"{tmp_path}/raw/{name}/{{year}}/*.parquet", output_dir=f"{tmp_path}/out", columns=columns)
    return spec("a", ["id", "year", "s"]), spec("b", ["id", "year", "v"])


def test_one_write_job_for_the_missing_slices_of_a_schema(spark, tables, tmp_path, monkeypatch):
    from pyspark.sql import DataFrameWriter

    a, b = tables
    backfill(spark, a, [2002])
    writes = []
    parquet = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *args, **kw: (writes.append(path), parquet(self, path, *args, **kw))[1])
    report = backfill_tables(spark, [(a, range(2001, 2006)), (b, [2001, 2003, 2005])])
    assert [(r["table"], r["year"], r["status"], r["rows"]) for r in report] == [
        ("a", 2001, "built", 1), ("a", 2002, "existing", None), ("a", 2003, "built", 3), ("a", 2004, "built", 4), ("a", 2005, "built", 5),
        ("b", 2001, "built", 10), ("b", 2003, "built", 0), ("b", 2005, "built", 10),
    ]
    assert len([w for w in writes if w.endswith("/new")]) == 2 and len(writes) == 3  # two schemas, and the slice without rows
    for r in report:
        df = spark.read.parquet(r["path"])
        assert set(df.columns) == {"id", "year", "filename", "s" if r["table"] == "a" else "v"}
        assert r["rows"] in (None, df.count())
        if r["rows"] is not None:
            assert json.load(open(f"{r['path']}/_SUCCESS")) == {"table": r["table"], "year": r["year"], "rows": r["rows"]}
    assert {r["status"] for r in backfill_tables(spark, [(a, range(2001, 2006)), (b, [2003])])} == {"existing"}
    assert sorted(os.listdir(tmp_path / "out")) == sorted([f"a_{y}.parquet" for y in range(2001, 2006)] + [f"b_{y}.parquet" for y in (2001, 2003, 2005)])


def test_a_slice_without_its_commit_record_is_built_again(spark, tables, tmp_path):
    a, _ = tables
    backfill(spark, a, [2001, 2002])
    os.remove(tmp_path / "out" / "a_2001.parquet" / "_SUCCESS")
    assert [r["status"] for r in backfill(spark, a, [2001, 2002])] == ["built", "existing"]
    assert spark.read.parquet(f"{tmp_path}/out/a_2001.parquet").count() == 1
    assert [r["status"] for r in backfill(spark, a, [2001], force=True)] == ["built"]


def partitioned(spark, path, years):
    spark.range(30).selectExpr("id", "CAST(2000 + id % 6 AS INT) AS year").where(f"year IN ({','.join(map(str, years))})").write.partitionBy("year").parquet(path)


def spec(year_min, year_max, **kw):
    return BuildSpec(name="t", year_min=year_min, year_max=year_max, path_pattern="{basepath}/t", output_name="t", year_column="year", **kw)


def test_years_of_a_partitioned_dataset(spark, tmp_path):
    partitioned(spark, f"{tmp_path}/t", range(2000, 2006))
    df = load_years(spark, spec(2001, 2003), str(tmp_path))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "2001" in plan
    assert sorted({r.year for r in df.collect()}) == [2001, 2002, 2003] and df.count() == 15
    built = build_table_df(spark, "t", spec(2001, 2003, primary_key=["year"]), str(tmp_path))
    assert sorted((r.year, len(r.id)) for r in built.collect()) == [(2001, 5), (2002, 5), (2003, 5)]


def test_absent_years_are_named_together(spark, tmp_path):
    partitioned(spark, f"{tmp_path}/t", [2000, 2002])
    with jobs(spark) as seen, pytest.raises(FileNotFoundError, match="2 of 4 years: 2001, 2003"):
        load_years(spark, spec(2000, 2003), str(tmp_path))
    assert seen.n == 0


def test_partitions_whose_files_differ(spark, tmp_path):
    partitioned(spark, f"{tmp_path}/t", [2000, 2001])
    spark.createDataFrame([("x", 5)], "id string, v int").write.parquet(f"{tmp_path}/t/year=2002")
    df = load_years(spark, spec(2001, 2002), str(tmp_path))
    assert dict(df.dtypes) == {"id": "string", "year": "int", "v": "int"}
    assert sorted((r.year, r.id, r.v) for r in df.collect())[-1] == (2002, "x", 5) and df.count() == 6


def test_sample_by_hash_is_independent_of_the_layout(spark):
    df = spark.range(5000).selectExpr("id", "IF(id % 7 = 0, NULL, id % 100) AS v", "map('k', id) AS m", "array(id, NULL) AS a")
    taken = [[r.id for r in sample_rows(df.repartition(n, "v"), 50, hash_of=["*"]).collect()] for n in (3, 7)]
    assert taken[0] == taken[1] and len(set(taken[0])) == 50
    assert max(taken[0]) > 4000 and min(taken[0]) < 1000  # spread over the table
    assert "TakeOrderedAndProject" in sample_rows(df, 50, hash_of=["id"])._jdf.queryExecution().executedPlan().toString()
