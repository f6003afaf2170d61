import pytest
from pyspark.sql import types as T

from conftest import rows
from panelforge.functions.types import SchemaConflictError, widen
from panelforge.operators.project import select_columns
from panelforge.operators.union import union_by_name
from panelforge.sources.parquet import glob_parquet, read_union, read_with_lineage, verify_paths_exist, year_paths

I, L, D, S = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()


@pytest.mark.parametrize(
    "a,b,want",
    [
        (I, L, L), (I, D, D), (I, S, S), (L, D, D), (L, S, S), (D, S, S),
        (T.DateType(), T.TimestampNTZType(), T.TimestampNTZType()),
        (T.DateType(), S, S), (T.TimestampNTZType(), S, S),
        (I, T.DecimalType(9, 2), T.DecimalType(12, 2)), (L, T.DecimalType(9, 2), T.DecimalType(21, 2)),
        (D, T.DecimalType(9, 2), D), (T.BooleanType(), I, I), (T.BooleanType(), D, D), (T.BooleanType(), S, S),
        (T.DecimalType(9, 2), T.BooleanType(), T.DecimalType(9, 2)),
        (T.ArrayType(I), T.ArrayType(S), T.ArrayType(S)),
    ],
)
def test_lattice(a, b, want):
    assert widen(a, b) == want and widen(b, a) == want


@pytest.mark.parametrize(
    "a,b",
    [(I, T.DateType()), (D, T.TimestampNTZType()), (T.DateType(), T.BooleanType()), (T.DecimalType(9, 2), T.DateType()), (I, T.ArrayType(I))],
)
def test_lattice_conflicts(a, b):
    with pytest.raises(SchemaConflictError):
        widen(a, b)


def test_u1_u2_u3_union(spark):
    a = spark.createDataFrame([(1, 10)], "a int, b int")
    b = spark.createDataFrame([(2,)], "a bigint")
    c = spark.createDataFrame([("x", 5)], "a string, z int")
    out = union_by_name([a, b, c])
    assert out.dtypes == [("a", "string"), ("b", "int"), ("z", "int")]
    assert sorted(rows(out), key=str) == sorted(
        [{"a": "1", "b": 10, "z": None}, {"a": "2", "b": None, "z": None}, {"a": "x", "b": None, "z": 5}], key=str
    )


def test_u4_conflict(spark):
    a = spark.createDataFrame([(1,)], "a int")
    b = spark.createDataFrame([], "a date")
    with pytest.raises(SchemaConflictError):
        union_by_name([a, b])


def test_union_case_insensitive_names(spark):
    a = spark.createDataFrame([(1,)], "Person_ID int")
    b = spark.createDataFrame([(2,)], "person_id int")
    out = union_by_name([a, b])
    assert out.columns == ["Person_ID"] and out.count() == 2


def test_u5_all_missing_years_listed(spark, tmp_path):
    spark.createDataFrame([(1,)], "a int").write.parquet(str(tmp_path / "t_2001.parquet"))
    paths = year_paths(str(tmp_path) + "/t_{year}.parquet", 2000, 2002)
    with pytest.raises(FileNotFoundError) as e:
        verify_paths_exist(spark, paths)
    assert "t_2000" in str(e.value) and "t_2002" in str(e.value) and "t_2001" not in str(e.value)


def test_read_union_single_scan_when_schemas_match(spark, tmp_path):
    for y in (2000, 2001):
        spark.createDataFrame([(y, "f")], "year int, filename string").write.parquet(str(tmp_path / f"t_{y}.parquet"))
    df = read_union(spark, [str(tmp_path / f"t_{y}.parquet") for y in (2000, 2001)])
    assert df.columns == ["year"]
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    spark.createDataFrame([(2002, 1.5)], "year int, x double").write.parquet(str(tmp_path / "t_2002.parquet"))
    df2 = read_union(spark, [str(tmp_path / f"t_{y}.parquet") for y in (2000, 2001, 2002)])
    assert df2.columns == ["year", "x"] and df2.count() == 3


def test_glob_and_lineage(spark, tmp_path):
    d = tmp_path / "raw"
    spark.createDataFrame([(1, "a", 9)], "id int, s string, extra int").coalesce(1).write.parquet(str(d / "p1"))
    spark.createDataFrame([(2, "b")], "id int, s string").coalesce(1).write.parquet(str(d / "p2"))
    files = glob_parquet(spark, str(d) + "/p*/*.parquet")
    assert len(files) == 2 and files == sorted(files)
    # the first file has an extra column: later files lacking it are an error
    with pytest.raises(ValueError):
        read_with_lineage(spark, files)
    files_rev = [files[1], files[0]]
    df = read_with_lineage(spark, files_rev)
    assert df.columns == ["id", "s", "filename"]
    got = sorted((r["id"], r["filename"].startswith("/"), "p1" in r["filename"] or "p2" in r["filename"]) for r in rows(df))
    assert got == [(1, True, True), (2, True, True)]
    with pytest.raises(FileNotFoundError):
        glob_parquet(spark, str(d) + "/none*/*.parquet")


def test_source_with_filename_refused(spark, tmp_path):
    p = str(tmp_path / "f.parquet")
    spark.createDataFrame([(1, "x")], "id int, filename string").write.parquet(p)
    with pytest.raises(ValueError):
        read_with_lineage(spark, glob_parquet(spark, p + "/*.parquet"))


def test_select_columns(spark):
    df = spark.createDataFrame([(1, 2, 3, "f")], "a int, b int, c int, filename string")
    assert select_columns(df, ["c", "a"]).columns == ["c", "a", "filename"]
    assert select_columns(df, ["filename", "b"]).columns == ["b", "filename"]
    assert select_columns(df, ["CAST(a AS STRING) AS a_txt"]).columns == ["a_txt", "filename"]
    with pytest.raises(ValueError):
        select_columns(df, [{"a": "int"}])
    with pytest.raises(KeyError):
        select_columns(df, ["a", "nope", "zip"])


def test_drift_lines():
    from panelforge.sources.parquet import drift_lines

    a = T.StructType([T.StructField("a", I), T.StructField("filename", S)])
    b = T.StructType([T.StructField("a", L), T.StructField("b", S)])
    lines = drift_lines([a, b], ["y1", "y2"], ignore=("filename",))
    assert any("'a' has types" in x for x in lines)
    assert any("'b' absent from ['y1']" in x for x in lines)
    assert not any("filename" in x for x in lines)
