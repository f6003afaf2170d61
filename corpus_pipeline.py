"""Corpus pipeline: quality rules, near duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on all documents that its predecessor kept. All
but the last return the columns of ``documents``; their decisions take effect: rejected documents
go, one document of each group of near duplicates stays, secrets are replaced in the texts. Null
text is rejected by the quality rules (it has no words). An empty table passes through empty. All but
the first stage have the executors give the memory of earlier ones back before they begin.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.functions.names import col
from panelforge.llm.jaccard import jaccard_join
from panelforge.llm.packing import pack_mixture
from panelforge.llm.quality import fit_quality, quality_rules
from panelforge.llm.queries import vocabulary
from panelforge.llm.secret_scan import fit_secrets, labelled_findings, scan_secrets
from panelforge.llm.tables import only, release_executors, staged, table


def _free(docs: DataFrame) -> str:
    """A name that no column of ``docs`` has."""
    taken, name = {c.lower() for c in docs.columns}, "stage_result"
    while name in taken:
        name += "_"
    return name


def _same(df: DataFrame, docs: DataFrame) -> DataFrame:
    """``df`` with the columns of ``docs`` alone, whatever characters their names hold."""
    return df.select([col(c) for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the calibrated regression keep. Ids play no part: rows with a
    null id or a repeated one are judged each by its text."""
    model, result = fit_quality(docs, table(spark, sf_dir, "labels")), _free(docs)
    return _same(quality_rules(docs, model, result_col=result).where(F.col(f"{result}.kept")), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the smallest id. A null id links with nothing.
    Of rows that repeat an id and a text one stays, the first by its other columns' text."""
    release_executors(spark)
    groups = jaccard_join(docs)
    kept = groups.where("component_id = doc_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    kept = staged(kept, "pipeline-stay")
    single = only(docs, kept.where("n = 1").select("doc_id"), "doc_id")
    several = only(docs, kept.where("n > 1").select("doc_id"), "doc_id")
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    first = F.min(F.struct(F.to_json(F.struct(*[col(c) for c in rest])).alias("order"), F.struct(*[col(c) for c in docs.columns]).alias("row")))
    several = several.groupBy("doc_id", "text").agg(first.alias("first")).select("first.row.*")
    none = docs.where("doc_id is null")
    return _same(single, docs).unionByName(_same(several, docs)).unionByName(none)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each secret replaced; ``n_chars`` counts the new text. Null text stays null;
    ids play no part in it."""
    release_executors(spark)
    model, result = fit_secrets(staged(labelled_findings(docs), "secret-labelled")), _free(docs)
    clean = scan_secrets(docs, model, result_col=result)
    clean = clean.withColumn("text", F.col(f"{result}.redacted"))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast("long"))
    return _same(clean, docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens, sources mixed to target shares. Rows with a
    null or repeated id are packed each for itself; null text is its end id alone."""
    release_executors(spark)
    return pack_mixture(docs, vocabulary("byte_bpe_50k.json"), end_id=1)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("secrets", secrets), ("packing", packing)]
#: SQL can't express the stages (a fitted model, tokenization): brute-force tests hold them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each one's rows are written as Parquet and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
