from pyspark.sql import types as T

from panelforge.functions.names import literal_rows, monthly_groups


def test_literal_rows_escapes_and_types(spark):
    schema = T.StructType(
        [T.StructField("y", T.LongType()), T.StructField("s", T.StringType()), T.StructField("b", T.BooleanType())]
    )
    data = [(1995, "it's", True), (2001, "back\\slash", None), (None, None, False)]
    df = literal_rows(spark, data, schema)
    assert df.dtypes == [("y", "bigint"), ("s", "string"), ("b", "boolean")]
    assert sorted(map(tuple, df.collect()), key=str) == sorted(data, key=str)
    assert literal_rows(spark, [], schema).count() == 0
    assert "Scan ExistingRDD" not in df._jdf.queryExecution().executedPlan().toString()


def test_monthly_groups():
    groups, static = monthly_groups(["id", "a_mo_02", "a_mo_01", "b_mo_01", "filename"], r"^(.+)_mo_(\d{2})$", ["filename"])
    assert groups == {"a": {2: "a_mo_02", 1: "a_mo_01"}, "b": {1: "b_mo_01"}}
    assert static == ["id"]


def test_fill_keeps_glob_braces():
    from panelforge.specs import BuildSpec, SelectSpec, fill

    assert fill("/raw/{year}/p-{a,b}*.parquet", year=2018) == "/raw/2018/p-{a,b}*.parquet"
    s = SelectSpec(name="t", path_pattern="/raw/{year}/{x,y}/*.parquet", columns=["a"], output_dir="/o")
    assert s.resolved_pattern(2001) == "/raw/2001/{x,y}/*.parquet" and s.output_path(2001) == "/o/t_2001.parquet"
    b = BuildSpec(name="t", year_min=2000, year_max=2001, path_pattern="{basepath}/t_{year}.parquet", output_name="t_{year_min}_{year_max}")
    assert b.year_path("/i", 2000) == "/i/t_2000.parquet" and b.formatted_output_name() == "t_2000_2001"
