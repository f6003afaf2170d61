import corpus_pipeline
from panelforge.llm.jaccard import jaccard_join
from panelforge.llm.secret_scan import candidates, rule_label

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = docs
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        seen = stage(spark, seen, SF)
        assert seen.columns == docs.columns
        seen = seen.cache()
        kept.append({r.doc_id: r.text for r in seen.select("doc_id", "text").collect()})
    quality, single, clean = kept
    assert set(single) <= set(quality) <= {r.doc_id for r in docs.select("doc_id").collect()}
    assert set(clean) == set(single)
    links = jaccard_join(spark.createDataFrame(list(quality.items()), "doc_id long, text string")).collect()
    assert set(single) == {r.component_id for r in links}
    assert not any(rule_label(t, a, b) for t in clean.values() for a, b in candidates(t))
    pieces = corpus_pipeline.STAGES[-1][1](spark, seen, SF).collect()
    assert {p.doc_id for p in pieces} == set(clean)


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
