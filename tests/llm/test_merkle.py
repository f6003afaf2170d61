import random
import zlib
from collections import defaultdict
from functools import partial
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from panelforge.llm import merkle, queries
from panelforge.llm.merkle import audit, build_manifest, height_of, level_sizes, log_nodes, position, proofs
from panelforge.llm.queries import LEAF_FIELDS, op13_merkle_manifest

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def H(*texts):
    return sha256("".join(texts).encode()).hexdigest()


def leaf(fields):
    return H(*["-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields])


def climb(digests):
    """(root, for each digest the levels of (before, behind) siblings) by plain recursion."""
    if len(digests) == 1:
        return digests[0], [[]]
    runs = [digests[i : i + 16] for i in range(0, len(digests), 16)]
    root, above = climb([H(*run) for run in runs])
    return root, [[("".join(run[:j]), "".join(run[j + 1 :]))] + above[i] for i, run in enumerate(runs) for j in range(len(run))]


def brute(rows):
    """Rows of the contract for (doc_id, source, lang, n_chars, text)."""
    by = defaultdict(list)
    for row in rows:
        by[row[1]].append(row)
    for own in by.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([leaf(r) for r in by[s]]) for s in names}
    root, tops = climb([trees[s][0] for s in names])
    out = []
    for s, top in zip(names, tops):
        subroot, paths = trees[s]
        for row, path in zip(by[s], paths):
            path = path + top
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None
            node = leaf((*row[:4], row[4].translate(LOW))) if hit else leaf(row)
            for before, behind in path:
                node = H(before, node, behind)
            out.append((row[0], leaf(row), subroot, root, H(*[a + b for a, b in path]), node, node == root))
    return sorted(out, key=str)


def found(spark, tmp_path, rows):
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    docs.repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = op13_merkle_manifest(spark, str(tmp_path)).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted(map(tuple, got.collect()), key=str)


@pytest.fixture(params=[1, 3])
def levels(request, monkeypatch):
    """Blocks of one level make many tiers out of a few rows."""
    monkeypatch.setattr(queries, "build_manifest", partial(build_manifest, levels=request.param))
    return request.param


def table(r, sizes):
    rows = []
    for source, n in sizes.items():
        rows += [(r.randint(0, 10**6) * 100 + len(rows) % 97, source, r.choice(["en", None]), r.choice([None, 5, -7]), r.choice([f"Text {i}", f"plain {i}", "", None])) for i in range(n)]
    r.shuffle(rows)
    return rows


def test_against_plain_recursion(levels, spark, tmp_path, monkeypatch):
    monkeypatch.setattr(merkle, "ROWS_EACH", 300)
    sizes = {None: 16, "": 17, "a": 1, "A": 2, "é": 257, "hot": 5000, "z\U0001f642": 33, "z￿": 255, **{f"s{i}": 1 for i in range(300)}}
    rows = table(random.Random(1), sizes)
    assert found(spark, tmp_path, rows) == brute(rows)


def test_odd_rows(levels, spark, tmp_path):
    rows = [(None, "s", None, None, None), (None, "s", "en", 1, "B"), (3, "s", "en", 1, "x" * 300_000), (3, "s", "en", 1, "Y"), (3, "s", "en", 1, "Y"), (7, None, None, None, "Z"), (-2**63, "t", "en", 2**62, "")]
    assert found(spark, tmp_path, rows) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(9, "only", "en", 1, "One")]])
def test_none_and_one(spark, tmp_path, rows):
    assert found(spark, tmp_path, rows) == (brute(rows) if rows else [])


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text")
    got = op13_merkle_manifest(spark, "/root/testdata/sf0.01").select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    assert sorted(map(tuple, got.collect()), key=str) == brute([tuple(r) for r in docs.collect()])


def naive_log(n):
    """(level, index) of all nodes in the order in which appending leaves completes them."""
    height, out = height_of(n), []
    for at in range(1, n + 1):
        level, index = 0, at - 1
        while True:
            out.append((level, index))
            last = at == n
            if level == height or not last and at % 16 ** (level + 1):
                break
            level, index = level + 1, index // 16
    return out


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 255, 256, 257, 300, 4096, 4097, 5000])
def test_closed_form_positions(n):
    order = naive_log(n)
    assert len(order) == sum(level_sizes(n, height_of(n)))
    for place, (level, index) in enumerate(order):
        assert position(level, index, n, height_of(n)) == place


def test_log_and_proofs(levels, spark):
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.expr("CASE WHEN id < 450 THEN 'a' WHEN id < 590 THEN 'b' END").alias("source"), F.lit("T").alias("meta.text"))
    manifest = build_manifest(docs, ["doc_id", "meta.text"], levels=levels)
    for r in proofs(manifest).collect():
        node = r.leaf.encode()
        assert r.leaf == leaf((r.id, "T"))
        for step in r.path:
            node = sha256(bytes(step.left) + node + bytes(step.right)).hexdigest().encode()
        assert node.decode() == r.root
    logs = defaultdict(list)
    for r in log_nodes(manifest.log).orderBy("position").collect():
        logs[r.tree].append(r)
    assert {t: len(v) for t, v in logs.items()} == {t: sum(level_sizes(n, height_of(n))) for t, n in (("=a", 450), ("=b", 140), ("", 10))}
    for own in logs.values():
        n = sum(r.level == 0 for r in own)
        assert [r.position for r in own] == list(range(len(own)))
        assert [r.level for r in own] == [level for level, _ in naive_log(n)]
        assert climb([r.digest for r in own if r.level == 0])[0] == own[-1].digest
    roots = {r.tree: bytes(r.root).hex() for r in manifest.log.roots.collect()}
    assert roots == {t: v[-1].digest for t, v in logs.items()}


def test_changed_leaf_is_found(spark):
    docs = spark.range(100).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"))
    changed = F.when(F.col("doc_id") == 42, F.sha2(F.lit("other"), 256))
    rows = audit(build_manifest(docs, LEAF_FIELDS[:2], changed=changed)).collect()
    assert [r.id for r in rows if not r.verified] == [42]
