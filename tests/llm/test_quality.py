import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from panelforge.llm.quality import fit_quality, labelled_sample, quality_rules

SF = "/root/testdata/sf0.01"


def expected(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    seen, covered, lines, repeated = Counter(runs), set(), set(), 0
    for i, run in enumerate(runs):
        if seen[run] > 1:
            covered.update(range(i, i + 5))
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in lines
            lines.add(line)
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), repeated, len(covered), failed


def measured(df, model):
    rows = quality_rules(df, model).select("text", "quality.*").collect()
    return [(r.text, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed), r) for r in rows]


def test_base_measures_on_odd_rows(odd_docs):
    rows = measured(odd_docs, None)
    assert len(rows) == odd_docs.count()
    for text, got, row in rows:
        assert got == expected(text)
        assert row.p_good is None and row.kept == (not row.base_failed)


def test_empty_tables(spark, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert fit_quality(no_docs, labels) is None
    assert quality_rules(no_docs, None).count() == 0


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_measures_and_held_out_accuracy(tables):
    docs, labels = tables
    model = fit_quality(docs, labels)
    rows = {r.doc_id: r for r in quality_rules(docs, model).select("doc_id", "text", "quality.*").collect()}
    for r in rows.values():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == expected(r.text)
        assert not (r.base_failed and r.kept)
    held = labelled_sample(docs, labels).where("held_out").select("id", "good").collect()
    good = [rows[r.id] for r in held if r.good == 1 and not rows[r.id].base_failed]
    bad = [rows[r.id] for r in held if r.good == 0]
    assert sum(r.kept for r in good) >= 0.95 * len(good)
    assert sum(r.kept for r in bad) <= 0.1 * len(bad)


def test_labels_with_nulls_and_contradictions(tables):
    docs, labels = tables
    odd = labels.select("doc_id", F.when(F.col("doc_id") % 7 == 0, None).otherwise(F.col("quality")).alias("quality"))
    twice = odd.unionByName(odd.where("quality = 1").limit(5).select("doc_id", F.lit(0).alias("quality")))
    ids = {r.id for r in labelled_sample(docs, twice).select("id").collect()}
    assert not any(i % 7 == 0 for i in ids)
    assert len(ids) == odd.where("quality is not null").count() - 5
