import os

import pytest
from pyspark.sql import functions as F

from conftest import jobs, rows
from panelforge.functions.types import SchemaConflictError
from panelforge.sources import footers
from panelforge.sources.footers import data_files, footer_counts, schema_groups
from panelforge.sources.parquet import glob_parquet, read_union, read_with_lineage


def one_file(spark, folder, name, data, schema):
    """A single data file of the given name in ``folder``."""
    spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{folder}.{name}.tmp")
    (part,) = [f for f in os.listdir(f"{folder}.{name}.tmp") if f.startswith("part-")]
    os.makedirs(folder, exist_ok=True)
    os.link(f"{folder}.{name}.tmp/{part}", f"{folder}/{name}.parquet")
    return f"{folder}/{name}.parquet"


def test_columns_of_some_files_of_a_slice_survive(spark, tmp_path):
    a, b = f"{tmp_path}/t_1", f"{tmp_path}/t_2"
    one_file(spark, a, "p1", [(1, 10, "f")], "id int, a int, filename string")
    one_file(spark, a, "p2", [(2, "x")], "id bigint, b string")
    one_file(spark, a, "p3", [(3, 30)], "ID int, A int")
    one_file(spark, b, "p1", [(4, 4.5)], "id int, a double")
    df = read_union(spark, [a, b])
    assert df.dtypes == [("id", "bigint"), ("a", "double"), ("b", "string")]
    assert rows(df, ["id"]) == [{"id": 1, "a": 10.0, "b": None}, {"id": 2, "a": None, "b": "x"}, {"id": 3, "a": 30.0, "b": None}, {"id": 4, "a": 4.5, "b": None}]


def test_types_without_a_common_one_name_the_slice(spark, tmp_path):
    one_file(spark, f"{tmp_path}/t_1", "p1", [(1,)], "a int")
    one_file(spark, f"{tmp_path}/t_1", "p2", [(None,)], "a date")
    with pytest.raises(SchemaConflictError, match="p2.parquet"):
        read_union(spark, [f"{tmp_path}/t_1"])


def test_a_slice_in_partition_folders(spark, tmp_path):
    spark.createDataFrame([(1, "x", 5), (2, "y", 6)], "id int, part string, v int").write.partitionBy("part").parquet(f"{tmp_path}/t_1")
    spark.createDataFrame([(3, "z")], "id int, part string").write.parquet(f"{tmp_path}/t_2")
    df = read_union(spark, [f"{tmp_path}/t_1", f"{tmp_path}/t_2"])
    assert sorted((r.id, r.part, r.v) for r in df.collect()) == [(1, "x", 5), (2, "y", 6), (3, "z", None)]


def test_folders_without_data_are_all_named(spark, tmp_path):
    os.makedirs(f"{tmp_path}/none_1")
    os.makedirs(f"{tmp_path}/none_2")
    spark.range(1).write.parquet(f"{tmp_path}/t")
    with pytest.raises(FileNotFoundError, match="none_1.*none_2"):
        read_union(spark, [f"{tmp_path}/none_1", f"{tmp_path}/t", f"{tmp_path}/none_2"])


def test_ten_thousand_files_in_a_few_jobs(spark, tmp_path):
    first = one_file(spark, f"{tmp_path}/raw", "a", [(1, "x")], "id int, s string")
    other = one_file(spark, f"{tmp_path}/raw", "b", [("2", "y", 9)], "id string, s string, extra int")
    for i in range(10_000):
        os.link(other if i % 4000 == 1 else first, f"{tmp_path}/raw/c{i:05d}.parquet")
    with jobs(spark) as listing:
        files = glob_parquet(spark, f"{tmp_path}/raw/*.parquet")
    assert len(files) == 10_002 and files == sorted(files)
    with jobs(spark) as footers_read:
        groups = schema_groups(spark, files)
    assert [len(g.files) for g in groups] == [9998, 4]
    assert listing.n == 0 and footers_read.n <= 4  # the footers (dealt out and read), and one file of each schema


def test_later_files_are_cast_to_the_first(spark, tmp_path):
    one_file(spark, f"{tmp_path}/raw", "a", [(1, "x")], "id int, s string")
    one_file(spark, f"{tmp_path}/raw", "b", [("2", "y", 9)], "id string, s string, extra int")
    df = read_with_lineage(spark, glob_parquet(spark, f"{tmp_path}/raw"))
    assert df.dtypes == [("id", "int"), ("s", "string"), ("filename", "string")]
    assert sorted((r.id, r.s, r.filename[-9:]) for r in df.collect()) == [(1, "x", "a.parquet"), (2, "y", "b.parquet")]


def test_files_that_tasks_cannot_reach(spark, tmp_path, monkeypatch):
    one_file(spark, f"{tmp_path}/raw", "a", [(1,)], "id int")
    one_file(spark, f"{tmp_path}/raw", "b", [(1,)], "id int")
    one_file(spark, f"{tmp_path}/raw", "c", [(1, 2)], "id int, b int")
    files = data_files(spark, f"{tmp_path}/raw")
    monkeypatch.setattr(footers, "_reader", lambda: lambda path: (path, None, None, []))
    assert [len(g.files) for g in schema_groups(spark, files)] == [2, 1]
    assert footer_counts(spark, files).collect()[0].asDict() == {"column_name": None, "n_files": 3, "n_rows": None, "null_count": None}


def test_counts_from_footers(spark, tmp_path):
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, F.col("id")).alias("meta.x"), F.array("id").alias("arr"), F.lit("c").alias("s"), F.struct("id").alias("st"))
    df.repartition(5).write.option("parquet.block.size", 1024).parquet(f"{tmp_path}/t")
    found = {r.column_name: (r.n_files, r.n_rows, r.null_count) for r in footer_counts(spark, data_files(spark, f"{tmp_path}/t")).collect()}
    assert found == {None: (5, 1000, None), "meta.x": (5, 1000, 666), "s": (5, 1000, 0)}


def test_profile_of_files_equals_a_scan(spark, tmp_path):
    from panelforge.operators.quality import profile, profile_files

    path = f"{tmp_path}/t"
    one_file(spark, path, "a", [(1, None, [1], 1.5), (None, "x", None, 2.5)], "id int, s string, arr array<int>, `d.x` double")
    one_file(spark, path, "b", [(3, None), (None, None)], "ID bigint, `d.x` double")
    df = read_union(spark, [path])
    key = lambda r: str(r)
    assert sorted(profile_files(spark, path).collect(), key=key) == sorted(profile(df).collect(), key=key)
    flat = f"{tmp_path}/flat"
    spark.range(100).selectExpr("IF(id % 4 = 0, NULL, id) AS id", "'c' AS c").write.parquet(flat)
    counted = profile_files(spark, flat)
    assert "Scan parquet" not in counted._jdf.queryExecution().toString()  # no data page is read
    assert {(r.check, r.column_name): r.value for r in counted.collect()} == {("row_count", None): 100, ("null_count", "id"): 25, ("null_count", "c"): 0}
    spark.range(0).write.parquet(f"{tmp_path}/none")
    assert {r.value for r in profile_files(spark, f"{tmp_path}/none").collect()} == {0}


def test_profile_of_files_that_tasks_cannot_reach(spark, tmp_path, monkeypatch):
    from panelforge.operators.quality import profile_files

    spark.range(10).selectExpr("nullif(id, 3) AS id").write.parquet(f"{tmp_path}/t")
    monkeypatch.setattr(footers, "_reader", lambda: lambda path: (path, None, None, []))
    assert sorted((r.check, r.value) for r in profile_files(spark, f"{tmp_path}/t").collect()) == [("null_count", 1), ("row_count", 10)]
