from pyspark.sql import functions as F

from panelforge.llm.secret_scan import REDACTED, candidates, fit_secrets, labelled_findings, rule_label, scan_secrets

SF = "/root/testdata/sf0.01"


def test_forest_agrees_with_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    fit, held = docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1")
    model = fit_secrets(labelled_findings(fit))
    right = total = 0
    for row in scan_secrets(held, model).select("text", "secrets").collect():
        spans = candidates(row.text)
        assert [(f.start, f.start + f.length) for f in row.secrets.findings] == spans
        kept = row.text
        for f in reversed(row.secrets.findings):
            total += 1
            right += f.is_secret == rule_label(row.text, f.start, f.start + f.length)
            if f.is_secret:
                kept = kept[: f.start] + REDACTED + kept[f.start + f.length :]
        assert row.secrets.redacted == kept
    assert total > 10 and right >= 0.95 * total


def test_forest_arrays_match_spark(spark):
    import numpy as np
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    from panelforge.llm.secret_scan import SecretModel, _trees

    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 4))
    rows = [(float(a[0] + a[1] * a[2] > 0), a.tolist()) for a in x]
    df = spark.createDataFrame(rows, "label double, f array<double>").select("label", array_to_vector("f").alias("features"))
    forest = RandomForestClassifier(numTrees=7, maxDepth=4, seed=1).fit(df)
    own = SecretModel(_trees(forest.toDebugString), frozenset())
    hard = np.array([[float(t.predict(r.features)) for t in forest.trees] for r in df.collect()]).mean(axis=1)
    assert len(own.trees) == 7
    assert np.allclose(own.probability(x), hard)


def test_odd_rows_without_a_model(odd_docs, no_docs):
    found = scan_secrets(odd_docs, None).collect()
    assert len(found) == odd_docs.count()
    for row in found:
        if row.text is None:
            assert row.secrets.redacted is None and row.secrets.findings == []
        elif "password" in row.text:
            assert row.secrets.redacted == f"key password={REDACTED} end"
        else:
            assert row.secrets.redacted == row.text
    assert scan_secrets(no_docs, None).count() == 0
    assert fit_secrets(labelled_findings(no_docs)) is None
    one_kind = labelled_findings(odd_docs).where(F.col("is_secret"))
    assert fit_secrets(one_kind) is None


def test_values_of_any_shape_beside_credential_words():
    cases = {
        "login with password=hunter2 now": "hunter2", "pwd: S3cr3t!x": "S3cr3t!x", 'secret = "correct-horse-battery"': "correct-horse-battery",
        "Password: Abc!defghijkl1mnop end": "Abc!defghijkl1mnop", "see ftp://bob:p!ss@host/x": "p!ss", "ssh bob:pass1@host": "pass1",
        '{"api_key": "x y z", "n": 1}': "x y z", "Authorization: Bearer a.b.c": "a.b.c", "token := 'q'": "q", "key password=32bb02aa3b580bf8ab end": "32bb02aa3b580bf8ab",
    }
    for text, value in cases.items():
        spans = candidates(text)
        assert [text[a:b] for a, b in spans] == [value], text
        assert rule_label(text, *spans[0]), text
    for text in ("the secret: patience is all", "Author: Smith", "mailto:bob@host.org", "no secret here"):
        assert not any(rule_label(text, a, b) for a, b in candidates(text)), text


def test_short_values_leave_the_texts(spark):
    r = __import__("random").Random(4)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    texts = [f"{word()} {word()} password={word()}{r.randint(1, 99)}! {word()}" for _ in range(60)]
    texts += [f"{word()} item{r.randint(10**9, 10**10)}code {word()} the token: {word()} {word()}" for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = fit_secrets(labelled_findings(docs))
    for row in scan_secrets(docs, model).collect():
        if "password" in row.text:
            assert row.secrets.redacted == row.text.split("=")[0] + "=" + REDACTED + row.text[row.text.rindex(" ") :]
        else:
            assert row.secrets.redacted == row.text
