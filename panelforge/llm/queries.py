"""One registered query for each operator, over its whole table, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.llm.exact_dedup import exact_dedup
from panelforge.llm.jaccard import jaccard_join
from panelforge.llm.merkle import audit, build_manifest, leaf_digest
from panelforge.llm.ngram_score import ngram_scores
from panelforge.llm.packing import pack_mixture
from panelforge.llm.quality import fit_quality, quality_rules
from panelforge.llm.secret_scan import fit_secrets, labelled_findings, scan_secrets
from panelforge.llm.simple8b import read_token_file, token_file
from panelforge.llm.tables import staged, table
from panelforge.llm.token_counts import token_counts
from panelforge.llm.unigram import decode_pieces, encode_pieces, load_vocabulary
from panelforge.llm.url_lists import canonical, url_list_join
from panelforge.llm.vectors import near_vectors
from panelforge.llm.whitening import whitened_rows


def vocabulary(name: str) -> str:
    """A public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _days(text, salt: str, span: int):
    """A number of days below ``span`` that depends on ``text`` only."""
    return F.pmod(F.conv(F.substring(F.md5(F.concat(text, F.lit(salt))), 1, 7), 16, 10).cast("long"), F.lit(span)).cast("int")


def capture_times(pages: DataFrame) -> DataFrame:
    """``pages`` with a fetch time: the tables hold none, so it follows from the address, within 2024."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), _days(F.col("url"), "fetch", 366))
    return pages.withColumn("fetched_at", F.when(F.col("url").isNotNull(), day))


def dated_list(pages: DataFrame) -> DataFrame:
    """A dated block list made from the pages' addresses, as large as their distinct hosts, folders
    and addresses make it: hosts whose names tell a category, and folders and addresses that a hash
    picks, with an addition each, removals for some, and a second addition for a few."""
    host, path = canonical(F.col("url"))
    urls = pages.select(host.alias("host"), path.alias("path")).where("host is not null").distinct()
    topic = F.regexp_extract("host", r"(adult|bets|casino|spam|pills|malware)", 1)
    hosts = urls.select("host").distinct().where(topic != "").select(F.concat(F.lit("h:"), "host").alias("key"), topic.alias("category"))
    folder = F.concat(F.lit("p:"), "host", F.regexp_extract("path", r"^(/[^/?]*/)", 1))
    folders = urls.where(F.col("path").rlike(r"^/[^/?]+/")).select(folder.alias("key")).distinct()
    folders = folders.where(_days(F.col("key"), "pick", 8) == 0).select("key", F.lit("folder").alias("category"))
    pages_ = urls.select(F.concat(F.lit("u:"), "host", "path").alias("key"))
    pages_ = pages_.where(_days(F.col("key"), "pick", 8) == 0).select("key", F.lit("address").alias("category"))
    keys = hosts.unionByName(folders).unionByName(pages_)
    added = F.date_add(F.lit("2023-10-01").cast("date"), _days(F.col("key"), "add", 300))
    removed = F.date_add(added, _days(F.col("key"), "stay", 200) + 1)
    again = F.date_add(removed, F.lit(30))
    step = lambda action, at: F.struct(F.lit(action).alias("action"), at.alias("at"))
    some, few = _days(F.col("key"), "stay", 2) == 0, _days(F.col("key"), "stay", 4) == 0
    log = F.array(step("add", added), F.when(some, step("remove", removed)), F.when(few, step("add", again)))
    return keys.select("key", "category", F.explode(F.filter(log, lambda x: x.isNotNull())).alias("e")).select("key", "category", "e.action", "e.at")


def op1_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's address against the dated list as of its fetch time."""
    pages = capture_times(table(spark, sf_dir, "pages").select("page_id", "url"))
    return url_list_join(pages, dated_list(pages))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document's source and of each of its lines, from one encoding of the whole."""
    return token_counts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures of every document and the verdict of the calibrated n-gram regression."""
    docs = table(spark, sf_dir, "documents")
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality_rules(docs.select("doc_id", "text"), model).select("doc_id", "quality.*")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces, and whether decoding them gives its text back (markers as spaces)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = load_vocabulary(vocabulary("piece_bpe_32k.model"))
    coded = encode_pieces(docs, pieces).select("doc_id", F.replace(F.coalesce("text", F.lit("")), F.lit("\u2581"), F.lit(" ")).alias("text"), "pieces.*")
    back = decode_pieces(coded, pieces)
    return back.select("doc_id", "n_tokens", "n_bytes", F.crc32("ids").alias("ids_crc32"), (F.col("decoded") == F.col("text")).alias("round_trip"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked at Jaccard similarity 0.8 on five-word shingles, and their components."""
    return jaccard_join(table(spark, sf_dir, "documents"))


def op6_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids written as Simple-8b blocks and read back."""
    docs = table(spark, sf_dir, "documents")
    return read_token_file(spark, token_file(docs, vocabulary("word_bpe_49k.json"), end_id=2))


def op7_sorted_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate embeddings of one label, at cosine 0.93."""
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op8_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens, sources mixed to target shares."""
    return pack_mixture(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=1)


def op9_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's stupid-backoff score against the trigram counts of all other documents."""
    return ngram_scores(table(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate for a secret in every document, with the forest's verdict."""
    docs = table(spark, sf_dir, "documents")
    model = fit_secrets(staged(labelled_findings(docs), "secret-labelled"))
    found = scan_secrets(docs.select("doc_id", "text"), model).select("doc_id", F.posexplode("secrets.findings").alias("finding", "f"))
    return found.select("doc_id", "finding", "f.*")


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays of its group of equal texts."""
    return exact_dedup(table(spark, sf_dir, "documents")).drop("row")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the four strongest whitened components of the distinct vectors."""
    return whitened_rows(table(spark, sf_dir, "embeddings"))


LEAF_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, roots and proof, and an audit in which some texts have lost their capitals."""
    docs = table(spark, sf_dir, "documents")
    plain = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hit = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    changed = F.when(hit, leaf_digest([F.col(c) for c in LEAF_FIELDS[:-1]] + [plain]))
    return audit(build_manifest(docs, LEAF_FIELDS, changed=changed)).withColumnRenamed("id", "doc_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_url_lists": op1_url_lists,
        "op2_token_counts": op2_token_counts,
        "op3_quality_rules": op3_quality_rules,
        "op4_sentencepiece": op4_sentencepiece,
        "op5_jaccard_join": op5_jaccard_join,
        "op6_simple8b": op6_simple8b,
        "op7_sorted_projections": op7_sorted_projections,
        "op8_mixture_packing": op8_mixture_packing,
        "op9_stupid_backoff": op9_stupid_backoff,
        "op10_secret_scan": op10_secret_scan,
        "op11_exact_dedup": op11_exact_dedup,
        "op12_whitening": op12_whitening,
        "op13_merkle_manifest": op13_merkle_manifest,
    }


URL_LISTS_SQL = r"""
WITH urls AS (
  SELECT page_id, url,
    regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.\-]*:', '') AS rest,
    CASE WHEN url IS NOT NULL THEN DATE '2024-01-01' + CAST(('0x' || substr(md5(url || 'fetch'), 1, 7))::BIGINT % 366 AS INTEGER) END AS fetched_at
  FROM pages),
split AS (
  SELECT page_id, url, fetched_at,
    nullif(lower(regexp_replace(regexp_replace(regexp_replace(regexp_extract(rest, '^//([^/?]*)', 1), '^.*@', ''), ':[0-9]*$', ''), '\.+$', '')), '') AS host,
    regexp_replace(rest, '^//[^/?]*', '') AS tail
  FROM urls),
seen AS (
  SELECT page_id, url, fetched_at, host, CASE WHEN tail LIKE '/%' THEN tail ELSE '/' || tail END AS path FROM split),
addresses AS (SELECT DISTINCT host, path FROM seen WHERE host IS NOT NULL),
keys AS (
  SELECT DISTINCT 'h:' || host AS key, regexp_extract(host, '(adult|bets|casino|spam|pills|malware)', 1) AS category
  FROM addresses WHERE regexp_matches(host, 'adult|bets|casino|spam|pills|malware')
  UNION ALL
  SELECT key, 'folder' FROM (SELECT DISTINCT 'p:' || host || regexp_extract(path, '^(/[^/?]*/)', 1) AS key FROM addresses WHERE regexp_matches(path, '^/[^/?]+/'))
  WHERE ('0x' || substr(md5(key || 'pick'), 1, 7))::BIGINT % 8 = 0
  UNION ALL
  SELECT key, 'address' FROM (SELECT 'u:' || host || path AS key FROM addresses)
  WHERE ('0x' || substr(md5(key || 'pick'), 1, 7))::BIGINT % 8 = 0),
dated AS (
  SELECT key, category, ('0x' || substr(md5(key || 'stay'), 1, 7))::BIGINT AS stay,
    DATE '2023-10-01' + CAST(('0x' || substr(md5(key || 'add'), 1, 7))::BIGINT % 300 AS INTEGER) AS added FROM keys),
removals AS (SELECT *, added + CAST(stay % 200 + 1 AS INTEGER) AS removed FROM dated),
intervals AS (
  SELECT key, category, added AS valid_from, CASE WHEN stay % 2 = 0 THEN removed END AS valid_to FROM removals
  UNION ALL
  SELECT key, category, removed + 30, NULL FROM removals WHERE stay % 4 = 0),
hits AS (
  SELECT s.page_id, s.url, count(*) AS n, string_agg(DISTINCT category, ',' ORDER BY category) AS categories, min(key) AS first_key
  FROM (SELECT DISTINCT page_id, url, fetched_at, host, path FROM seen) s JOIN intervals i
    ON (i.key[1] = 'h' AND ('.' || s.host) LIKE ('%.' || substr(i.key, 3))
     OR i.key[1] = 'p' AND starts_with(s.host || regexp_replace(s.path, '\?.*$', ''), substr(i.key, 3))
     OR i.key = 'u:' || s.host || s.path)
    AND s.fetched_at >= i.valid_from AND (i.valid_to IS NULL OR s.fetched_at < i.valid_to)
  GROUP BY s.page_id, s.url)
SELECT s.page_id, s.host, s.fetched_at, coalesce(n, 0) AS n_matches, coalesce(categories, '') AS categories, first_key, n IS NOT NULL AS blocked
FROM seen s LEFT JOIN hits h ON s.page_id = h.page_id AND s.url = h.url
"""


EXACT_DEDUP_SQL = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM d WINDOW same AS (PARTITION BY text_sha256)
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_url_lists": URL_LISTS_SQL, "op11_exact_dedup": EXACT_DEDUP_SQL}
