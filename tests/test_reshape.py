import pytest
from pyspark.sql import functions as F

from conftest import rows
from panelforge.operators.reshape import explode_periods, unpivot_monthly


def _explode(spark, data, schema, n):
    return rows(explode_periods(spark.createDataFrame(data, schema), "month", n), ["id", "month"])


def test_r1_short_array_gives_null(spark):
    out = _explode(spark, [(1, [10, 20])], "id int, a array<int>", 3)
    assert [(r["month"], r["a"]) for r in out] == [(1, 10), (2, 20), (3, None)]


def test_r2_null_array(spark):
    out = _explode(spark, [(1, None)], "id int, a array<int>", 3)
    assert [r["a"] for r in out] == [None, None, None]


def test_r3_long_array_truncated_to_n(spark):
    out = _explode(spark, [(1, list(range(14)))], "id int, a array<int>", 12)
    assert len(out) == 12 and out[-1]["a"] == 11


def test_r4_nested_arrays_outer_level(spark):
    out = _explode(spark, [(1, [[1, 2], [3]])], "id int, a array<array<int>>", 3)
    assert [r["a"] for r in out] == [[1, 2], [3], None]


def test_r5_no_array_column(spark):
    with pytest.raises(ValueError):
        explode_periods(spark.createDataFrame([(1,)], "id int"))


def test_explode_column_order_and_lineage_kept(spark):
    df = spark.createDataFrame([(1, [1], "x", ["a"], "f.parquet")], "id int, a array<int>, s string, b array<string>, filename string")
    out = explode_periods(df, "month", 2)
    assert out.columns == ["id", "s", "filename", "month", "a", "b"]
    assert dict(out.dtypes)["month"] == "int"
    assert out.count() == 2


def test_period_collision(spark):
    df = spark.createDataFrame([(1, [1])], "month int, a array<int>")
    with pytest.raises(ValueError):
        explode_periods(df)


def test_m1_missing_month_is_null_and_lineage_dropped(spark):
    df = spark.createDataFrame([(7, 1, 3, "f")], "id int, x_mo_01 int, x_mo_03 int, filename string")
    out = unpivot_monthly(df, n_periods=3)
    assert out.columns == ["id", "month", "x"]
    assert [(r["month"], r["x"]) for r in rows(out, ["month"])] == [(1, 1), (2, None), (3, 3)]


def test_m2_types_widen_across_months(spark):
    df = spark.createDataFrame([(1, "b")], "x_mo_01 int, x_mo_02 string")
    out = unpivot_monthly(df, n_periods=2)
    assert dict(out.dtypes)["x"] == "string"
    assert sorted(r["x"] for r in rows(out)) == ["1", "b"]


def test_m3_months_beyond_n_ignored(spark):
    df = spark.createDataFrame([(1, 2)], "x_mo_01 int, x_mo_13 int")
    out = unpivot_monthly(df, n_periods=12)
    assert out.count() == 12 and rows(out.where("month = 1"))[0]["x"] == 1


def test_m4_no_monthly_columns(spark):
    with pytest.raises(ValueError):
        unpivot_monthly(spark.createDataFrame([(1,)], "a int"))


def test_all_null_months_kept_and_bases_in_first_seen_order(spark):
    df = spark.createDataFrame([(1, None, None, None, None)], "id int, b_mo_01 int, a_mo_01 int, b_mo_02 int, a_mo_02 int")
    out = unpivot_monthly(df, n_periods=2)
    assert out.columns == ["id", "month", "b", "a"]
    assert out.count() == 2


def test_custom_pattern(spark):
    df = spark.createDataFrame([(1, "y", "n", 5)], "id int, hmo_01 string, hmo_02 string, hmo_total int")
    out = unpivot_monthly(df, n_periods=2, pattern=r"^(hmo|buyin)_(\d{2})$")
    assert out.columns == ["id", "hmo_total", "month", "hmo"]


def test_unpivot_is_one_scan(spark, tmp_path):
    p = str(tmp_path / "wide.parquet")
    spark.createDataFrame([(1, 1, 2, 3)], "id int, x_mo_01 int, x_mo_02 int, x_mo_03 int").write.parquet(p)
    out = unpivot_monthly(spark.read.parquet(p), n_periods=3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    assert out.count() == 3
