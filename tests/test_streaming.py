from pyspark.sql import functions as F

from conftest import SF_SMALL
from panelforge.specs import SelectSpec
from panelforge.streaming import run_incremental


def test_incremental_processes_only_new_files(spark, tmp_path):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    raw = tmp_path / "raw"

    def deliver(year):
        part = o.where(F.year("o_orderdate") == year).select(
            "o_custkey", F.year("o_orderdate").alias("year"),
            F.array(*[F.when(F.month("o_orderdate") == m, F.col("o_totalprice")) for m in range(1, 13)]).alias("amt"),
        )
        part.coalesce(1).write.parquet(str(raw / f"y{year}"))
        return part.count()

    spec = SelectSpec(name="amt", path_pattern="", columns=["o_custkey", "year", "amt"], explode_arrays=True)
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    n1 = deliver(1996)
    run_incremental(spark, spec, str(raw) + "/*/*.parquet", out, checkpoint_location=ckpt)
    first = spark.read.parquet(out)
    assert first.count() == n1 * 12
    assert set(first.columns) == {"o_custkey", "filename", "month", "amt", "year"}
    n2 = deliver(1997)
    run_incremental(spark, spec, str(raw) + "/*/*.parquet", out, checkpoint_location=ckpt)
    both = spark.read.parquet(out)
    assert both.count() == (n1 + n2) * 12
    assert {r["year"]: r["n"] for r in both.groupBy("year").agg(F.count(F.lit(1)).alias("n")).collect()} == {1996: n1 * 12, 1997: n2 * 12}


def one(spark, folder, data, schema):
    spark.createDataFrame(data, schema).coalesce(1).write.parquet(str(folder))


def test_later_types_are_cast_to_the_first_file_for_good(spark, tmp_path):
    raw, out, ckpt = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "ckpt")
    spec = SelectSpec(name="t", path_pattern="", columns=["id", "year", "v"])
    run = lambda: run_incremental(spark, spec, f"{raw}/*/*.parquet", out, checkpoint_location=ckpt, max_files_per_batch=2)
    one(spark, raw / "m1", [(1, 2001, 5)], "id int, year int, v int")
    one(spark, raw / "m2", [("2", 2001, 6.0)], "id string, year int, v double")
    one(spark, raw / "m3", [(3, "2002", "7", "extra")], "id bigint, year string, v string, more string")
    run()
    one(spark, raw / "a0", [("4", 2002, "8")], "id string, year int, v string")  # sorts before the first file
    run()
    run()  # nothing new
    found = spark.read.parquet(out)
    assert dict(found.dtypes) == {"id": "int", "v": "int", "filename": "string", "year": "int"}
    assert sorted((r.id, r.year, r.v, r.filename.split("/")[-2]) for r in found.collect()) == [(1, 2001, 5, "m1"), (2, 2001, 6, "m2"), (3, 2002, 7, "m3"), (4, 2002, 8, "a0")]


def test_a_delivery_processed_again_replaces_its_files(spark, tmp_path):
    from panelforge.streaming.incremental import write_delivery

    out = str(tmp_path / "out")
    write_delivery(spark.range(10).selectExpr("id", "id % 2 AS year"), out, "s-000000", "year")
    write_delivery(spark.range(5).selectExpr("id + 100 AS id", "id % 3 AS year"), out, "s-000001", "year")
    write_delivery(spark.range(10).repartition(3).selectExpr("id", "id % 2 AS year"), out, "s-000000", "year")
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [*range(10), *range(100, 105)]
