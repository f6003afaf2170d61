import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from panelforge.llm import exact_dedup as op
from panelforge.llm.exact_dedup import exact_dedup, without_copies
from panelforge.llm.queries import op11_exact_dedup

SF = "/root/testdata/sf0.01"
SPACE = re.compile(r"[\x20\x09-\x0D]+")


def digest(text):
    return hashlib.sha256(SPACE.sub(" ", text or "").encode()).hexdigest()


def check(pairs, rows):
    """``rows`` of the operator against plain Python groups of the (id, text) ``pairs``."""
    groups = defaultdict(list)
    for i, t in pairs:
        groups[digest(t)].append(i)
    assert len(rows) == len(pairs)
    seen = defaultdict(list)
    for r in rows:
        ids = groups[r.text_sha256]
        known = [i for i in ids if i is not None]
        assert r.group_size == len(ids)
        assert r.keep_id == (min(known) if known else None)
        seen[r.text_sha256].append(r)
    for h, found in seen.items():
        assert sorted((r.doc_id is None, r.doc_id) for r in found) == sorted((i is None, i) for i in groups[h])
        kept = [r for r in found if r.kept]
        assert len(kept) == 1 and kept[0].doc_id == kept[0].keep_id


@pytest.fixture(params=["broadcast", "shuffled", "heavy"])
def way(request, monkeypatch):
    if request.param != "broadcast":
        monkeypatch.setattr(op, "BROADCAST_KEYS", -1)
    if request.param == "heavy":
        monkeypatch.setattr(op, "HEAVY_PART", 10**9)


def test_odd_rows(way, odd_docs):
    check([(r.doc_id, r.text) for r in odd_docs.collect()], exact_dedup(odd_docs).collect())


def test_groups_of_all_sizes(way, spark):
    r = random.Random(3)
    texts = [" ".join(str(r.randint(0, 99)) for _ in range(3)) for _ in range(3000)]
    texts += ["the hot text"] * 1500 + ["the  hot\ttext"] * 500 + [None] * 40 + [""] * 40 + [" \n"] * 30
    ids = list(range(len(texts)))
    r.shuffle(ids)
    pairs = list(zip(ids, texts))
    check(pairs, exact_dedup(spark.createDataFrame(pairs, "doc_id long, text string").repartition(7)).collect())


def test_all_rows_of_the_table_and_its_sql(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], op11_exact_dedup(spark, SF).collect())


def test_filter_passes_most_single_texts(spark):
    """The filter's false positives: rows that are shuffled although their text is the only one."""
    n = 20_000
    rows = spark.range(n).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"))
    word = F.pmod(F.xxhash64("digest"), F.lit(op.WORDS_EACH * n))
    lanes = op._lanes(F.col("digest"))
    words = rows.select("digest", word.alias("word"), op._bits(*lanes, op.LANE_BITS).alias("units"))
    own = op._bits(*lanes, 1)
    maybe = words.join(op.seen_again(words), "word").where(F.col("again").bitwiseAND(own) == own).count()
    assert maybe < 0.05 * n


def test_main_path_is_native_and_empty_tables(no_docs, odd_docs):
    assert exact_dedup(no_docs).count() == 0
    plan = exact_dedup(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_whole_rows_come_back_whatever_their_names(spark):
    names = ["doc_id", "text", "kept", "row", "digest", "met", "meta.url", "group_size"]
    rows = [(1, "a b", 1, "r", "d", 1.5, "u", 9), (2, "a  b", 2, "r", "d", 1.5, "u", 9), (2, "c", 3, None, "d", None, "v", 9)]
    docs = spark.createDataFrame(rows, names)
    stay = without_copies(docs)
    assert stay.columns == names
    assert sorted(map(tuple, stay.collect())) == [rows[0], rows[2]]
