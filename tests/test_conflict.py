import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from panelforge.operators.conflict import conflict_aggregate, conflict_summary, duplicate_key_counts, duplicate_keys


def test_n1_basic_arrays_and_counts(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "z")], "k int, v string")
    out = rows(conflict_aggregate(df, ["k"]), ["k"])
    assert out == [
        {"k": 1, "v": ["a", "b"], "n_distinct_v": 2},
        {"k": 2, "v": ["z"], "n_distinct_v": 1},
    ]


def test_n2_null_keys_never_merge(spark):
    df = spark.createDataFrame([(None, "x"), (None, "y")], "k int, v string")
    out = sorted((r["v"], r["n_distinct_v"]) for r in rows(conflict_aggregate(df, ["k"])))
    assert out == [(["x"], 1), (["y"], 1)]


def test_n3_partial_null_key(spark):
    df = spark.createDataFrame([(1, None, "p"), (1, None, "q"), (1, 2, "r")], "a int, b int, v string")
    out = rows(conflict_aggregate(df, ["a", "b"]))
    assert len(out) == 3
    assert sorted(r["v"][0] for r in out) == ["p", "q", "r"]
    assert all(len(r["v"]) == 1 for r in out)


def test_n4_n5_null_values_kept_count_zero(spark):
    df = spark.createDataFrame([(3, None), (3, None), (4, None)], "k int, v string")
    out = {r["k"]: (r["v"], r["n_distinct_v"]) for r in rows(conflict_aggregate(df, ["k"]))}
    assert out == {3: ([None, None], 0), 4: ([None], 0)}


def test_n6_arrays_aligned(spark):
    df = spark.createDataFrame([(5, "a", None), (5, None, "b")], "k int, v string, w string")
    r = rows(conflict_aggregate(df, ["k"]))[0]
    pairs = sorted(zip(r["v"], r["w"]), key=str)
    assert pairs == sorted([("a", None), (None, "b")], key=str)


def test_n7_array_values_compared_by_value(spark):
    df = spark.createDataFrame([(1, ["a, b"]), (1, ["a", "b"])], "k int, v array<string>")
    r = rows(conflict_aggregate(df, ["k"]))[0]
    assert r["n_distinct_v"] == 2


def test_map_values_counted_by_text_and_map_keys_refused(spark):
    df = spark.createDataFrame([(1, {"a": 1}), (1, {"a": 1}), (1, {"b": 2})], "k int, m map<string,int>")
    r = rows(conflict_aggregate(df, ["k"]))[0]
    assert r["n_distinct_m"] == 2 and len(r["m"]) == 3
    import pytest

    with pytest.raises(TypeError):
        conflict_aggregate(df, ["m"])


def test_missing_key_and_name_collision(spark):
    import pytest

    df = spark.createDataFrame([(1, 2)], "k int, v int")
    with pytest.raises(KeyError):
        conflict_aggregate(df, ["nope"])
    df2 = spark.createDataFrame([(1, 2, 3)], "k int, v int, n_distinct_v int")
    with pytest.raises(ValueError):
        conflict_aggregate(df2, ["k"])


def test_invariants_on_lineitem(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    n = li.count()
    out = conflict_aggregate(li, ["l_orderkey", "l_linenumber"])
    values = [c for c in li.columns if c not in ("l_orderkey", "l_linenumber")]
    agg = out.agg(
        F.sum(F.size("l_partkey")).alias("total"),
        F.count(F.lit(1)).alias("keys"),
        F.countDistinct("l_orderkey", "l_linenumber").alias("distinct_keys"),
        F.sum(
            F.when(F.greatest(*[F.size(v) for v in values]) != F.least(*[F.size(v) for v in values]), 1).otherwise(0)
        ).alias("misaligned"),
        F.sum(
            F.when(
                F.greatest(*[F.col(f"n_distinct_{v}") for v in values]) > F.size("l_partkey"), 1
            ).otherwise(0)
        ).alias("too_many"),
    ).first()
    assert agg["total"] == n
    assert agg["keys"] == agg["distinct_keys"] == li.select("l_orderkey", "l_linenumber").distinct().count()
    assert agg["misaligned"] == 0 and agg["too_many"] == 0


def test_one_row_for_each_key_at_any_size(spark):
    def src(parts):
        ids = spark.range(0, 100_001 + 300, 1, parts)
        return ids.select(
            F.when(F.col("id") <= 100_000, F.lit(0)).otherwise(F.col("id")).alias("k"),
            (F.col("id") % 17).alias("v"),
            F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id") % 3).alias("w"),
        )

    out = conflict_aggregate(src(3), ["k"])
    assert out.columns == ["k", "v", "n_distinct_v", "w", "n_distinct_w"]
    assert out.count() == 301
    hot = out.where("k = 0").first()
    assert len(hot.v) == len(hot.w) == 100_001 and (hot.n_distinct_v, hot.n_distinct_w) == (17, 3)
    assert list(zip(hot.v, hot.w)) == sorted(zip(hot.v, hot.w), key=lambda r: (r[0], r[1] is not None, r[1] or 0))
    assert conflict_aggregate(src(7), ["k"], pieces=3).where("k = 0").first() == hot
    summ = {s["column_name"]: s for s in rows(conflict_summary(out, ["k"]))}
    assert summ["v"]["n_keys"] == 301 and summ["v"]["n_conflict_keys"] == 1 and summ["v"]["max_n_distinct"] == 17


def test_key_filters_reach_the_scan(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    plan = conflict_aggregate(li, ["l_orderkey", "l_linenumber"])._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(l_orderkey)" in plan and "Python" not in plan


def test_duplicate_keys_counts_null_group(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k int")
    out = sorted((r["k"] is None, r["n_rows"]) for r in rows(duplicate_keys(df, ["k"])))
    assert out == [(False, 2), (True, 2)]


def test_nested_distinct_counts(spark):
    n = 4000
    ts = F.expr("timestamp'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id % 3 / 1000000)")
    df = spark.range(n).select(
        F.lit(1).alias("k"),
        F.array(F.col("id") % 2000, F.lit(1)).alias("a"),
        F.struct((F.col("id") % 7).alias("x"), F.lit(None).cast("int").alias("y")).alias("s"),
        F.array(ts).alias("t"),
        F.when(F.col("id") % 2 == 0, F.create_map(F.lit("a"), F.col("id") % 5)).alias("m"),
    )
    for hot_keys, counted in ((None, "collect_set"), (5, "array_distinct(flatten")):
        out = conflict_aggregate(df, ["k"], hot_keys=hot_keys, hot_rows=100)
        r = out.select(*[f"n_distinct_{c}" for c in "astm"], F.size("a").alias("n")).first()
        assert tuple(r) == (2000, 7, 3, 5, n)
        assert counted in out._jdf.queryExecution().analyzed().toString()  # hashed sets


def test_both_duplicate_figures(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (None, 2), (None, 2), (2, None), (3, 3)], "a int, b int")
    assert tuple(duplicate_key_counts(df, ["a", "b"]).first()) == (1, 2)
    assert tuple(duplicate_key_counts(df.limit(0), ["a", "b"]).first()) == (0, 0)


def test_user_columns_named_like_internal_helpers(spark):
    df = spark.createDataFrame([(1, 1, 2, 3, 4), (1, 5, 6, 7, 8)], "k int, _rows int, _h int, _n int, _parts int")
    r = rows(conflict_aggregate(df, ["k"]))
    assert [x["_rows"] for x in r] == [[1, 5]] and r[0]["n_distinct__h"] == 2


def test_edge_inputs(spark):
    empty = spark.createDataFrame([], "k int, v string")
    out = conflict_aggregate(empty, ["k"])
    assert out.count() == 0 and out.columns == ["k", "v", "n_distinct_v"]
    all_null = spark.createDataFrame([(None, "a"), (None, "a")], "k int, v string")
    assert conflict_aggregate(all_null, ["k"]).count() == 2
    keys_only = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    got = sorted((r["k"] is None, r["k"] or 0) for r in conflict_aggregate(keys_only, ["k"]).collect())
    assert got == [(False, 1), (False, 2), (True, 0)]


@pytest.mark.parametrize("hot_keys", [0, 10, 10_000])
@pytest.mark.parametrize("hot_rows", [1, 3])
def test_result_is_equal_for_any_sketch(spark, hot_keys, hot_rows):
    df = spark.range(4000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 5 = 0 THEN concat('k', id % 40) WHEN id % 7 = 0 THEN NULL ELSE CAST(id AS STRING) END AS k",
        "CAST(id % 11 AS DOUBLE) AS v", "array(id % 2, id % 3) AS nested", "IF(id % 4 = 0, NULL, 'x') AS s",
    )
    key = lambda r: (r["k"] is not None, str(r))
    plain = sorted(rows(conflict_aggregate(df, ["k"], hot_keys=0)), key=key)
    assert sorted(rows(conflict_aggregate(df, ["k"], hot_keys=hot_keys, hot_rows=hot_rows)), key=key) == plain


def test_a_hot_key_is_collected_in_segments(spark):
    """No row holds a whole hot key; the segments hold each source row once, with the key's own counts."""
    from panelforge.operators.conflict import key_counts

    df = spark.range(0, 6000, 1, 6).selectExpr(
        "CASE WHEN id < 5000 THEN 0 WHEN id < 5003 THEN NULL ELSE id div 4 END AS k", "id % 700 AS a",
        "IF(id % 3 = 0, NULL, 1) AS b", "array(id % 5, NULL) AS c", "7 AS same",
    )
    options = {"hot_rows": 1000, "hot_keys": 10}
    whole = conflict_aggregate(df, ["k"], **options)
    agg = conflict_aggregate(df, ["k"], segment_rows=500, **options).cache()
    assert agg.columns == [*whole.columns, "segment"]
    hot = agg.where("k = 0")
    assert hot.count() == 10 and hot.selectExpr("max(size(a)) AS n").first().n < 1000
    assert agg.where("k != 0 OR k IS NULL").agg({"segment": "max"}).first()[0] == 0
    flat = lambda t: sorted(t.selectExpr("k", "inline(arrays_zip(a, b, c, same))").collect(), key=repr)
    assert flat(agg) == flat(whole)
    counts = [c for c in whole.columns if c.startswith("n_distinct_")]
    assert sorted(key_counts(agg, ["k"]).collect(), key=repr) == sorted(whole.selectExpr("k", "CAST(size(a) AS BIGINT) AS n_rows", *counts).collect(), key=repr)


def test_equal_rows_of_a_hot_key_are_dealt_over_its_segments(spark):
    df = spark.range(0, 8000, 1, 8).selectExpr("1 AS k", "5 AS v")
    agg = conflict_aggregate(df, ["k"], hot_rows=1000, hot_keys=10, segment_rows=1000).collect()
    assert sum(len(r.v) for r in agg) == 8000 and max(len(r.v) for r in agg) < 8000
    assert {r.n_distinct_v for r in agg} == {1}
