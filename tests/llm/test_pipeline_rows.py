"""Odd rows and names in the pipeline's stages."""

import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from .conftest_words import WORDS
from panelforge.llm.secret_scan import LIKELY, candidates, labelled_findings

SF = "/root/testdata/sf0.001"


def text(i):
    return " ".join(WORDS[(i * 7 + j * (i + 3)) % len(WORDS)] for j in range(60)) + f" number{i}"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, text(i), f"u{i}", "mine") for i in range(8)]
    rows += [(1, text(1), "u1", "mine"), (1, text(1), "u0", "mine"), (2, text(90), "other", "mine"), (None, text(50), "n", "mine"), (None, text(50), "n", "mine")]
    return spark.createDataFrame(rows, "doc_id long, text string, `meta.url` string, stage_result string").withColumns({"Stage Result": F.lit(1), "source": F.lit("s")})


def test_names_and_repeated_rows(spark, odd):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, SF)
        assert out.columns == odd.columns
        rows = out.collect()
        assert all(r.stage_result == "mine" and r["meta.url"] for r in rows)
        if name == "near_duplicates":
            assert sorted((r.doc_id, r["meta.url"]) for r in rows if r.doc_id is not None) == sorted([(i, f"u{i}") for i in range(8) if i != 1] + [(1, "u0"), (2, "other")])
            assert sum(r.doc_id is None for r in rows) == 2
    assert corpus_pipeline.packing(spark, odd, SF).select("doc_id").distinct().count() == 9


def test_long_runs_are_searched_in_linear_time(spark):
    runs = ["x" * 1_000_000, ":" * 1_000_000, "a:" * 500_000, "user:" + "y" * 1_000_000, "0" * 1_000_000, "a1" * 500_000, "password=" * 100_000, "@" * 1_000_000]
    docs = spark.createDataFrame(list(enumerate(runs)), "doc_id long, text string")
    began = time.time()
    assert docs.where(F.col("text").rlike(LIKELY)).count() >= 1
    labelled_findings(docs).count()
    assert time.time() - began < 60
    for run in runs:
        began = time.time()
        candidates(run)
        assert time.time() - began < 20


def test_rare_secrets_are_in_the_sample(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") == 1234, "password = hunter2secret9x").otherwise(F.concat(F.lit("see build 20240101abc"), F.col("id"))).alias("text"))
    found = labelled_findings(docs, max_documents=100).collect()
    assert {r.id for r in found if r.is_secret} == {1234} and len({r.id for r in found}) == 51
