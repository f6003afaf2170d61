"""Secret scan: candidates by shape, judged by a random forest that removes false positives.

A candidate is a run of at least ``MIN_LENGTH`` characters of ``[A-Za-z0-9+/_-]`` with a digit, or,
whatever its length and characters, a value that is assigned to a word for credentials on its line
(in quotes what they hold, else up to a space) or the password of ``user:password@host``.
The forest sees its length, character classes and their transitions, how much of it a dictionary
covers, whether it stands in a path or address, and the words beside it. Spark fits the forest on
a bounded sample of labelled findings; its trees are then broadcast as small arrays, so that
texts are scanned, judged and redacted in one map over the rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import arrow_udf

from panelforge.llm.tables import ship, staged
from panelforge.llm.textops import tidy

MIN_LENGTH = 12
RUN = re.compile(r"[A-Za-z0-9+/_\-]{%d,}" % MIN_LENGTH)
DIGIT = re.compile(r"[0-9]")
BESIDE = 48  # characters looked at on either side
WORD = re.compile(r"[A-Za-z]{3,}")
CREDENTIAL = re.compile(r"(?i)(passw|pwd|secret|token|api_?key|access_?key|private|credential|auth|bearer)")
ASSIGNED = re.compile(r"[=:]\s*[\"'`]?$")
ADDRESS = re.compile(r"(://|www\.|@|[/\\])[^\s]*$")
#: What stands before a value that is assigned to a word for credentials.
HEAD = r"(?:passw|pwd|secret|token|api[_-]?key|access[_-]?key|private|credential|auth(?!ors?\b)|bearer)[\w\-]{0,40}[\"'`\]]{0,2}[ \t]{0,16}(?::=|={1,3}>?|:(?!//))[ \t]{0,16}(?:(?:bearer|basic)[ \t]+)?"
VALUE = re.compile(HEAD + r"(?:(?P<q>[\"'`])(?P<quoted>[^\n]+?)(?P=q)|(?P<bare>\S+))", re.I)
HEADED = re.compile(HEAD + r"[\"'`]?$", re.I)
LOGIN = re.compile(r"(?:(?<![\w.+\-])[\w.+\-]+|://):([^\s/]{1,512})@(?=[\w\[])")
LOGGED = re.compile(r"(?:(?<![\w.+\-])([\w.+\-]+)|://):$")
MAIL = re.compile(r"(?i)(e-?mail|mail|mailto|contact|from|to|cc|bcc|reply-to|sip|sips|xmpp|acct)")
#: Shapes of keys that a provider issues with a fixed prefix.
ISSUED = re.compile(r"(AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|xox[abpr]-[0-9A-Za-z-]{10,}|sk_live_[0-9A-Za-z]{16,}")
#: Labelled findings that the forest is fitted on, at most; documents they may come from, at most.
MAX_LABELLED = 20_000
MAX_DOCUMENTS = 4000
MAX_WORDS = 5000  # of the dictionary
MIN_PROBABILITY = 0.5
REDACTED = "[SECRET]"

FEATURES = (
    "length", "digits", "upper", "lower", "hex", "transitions", "entropy", "vowel_pairs", "dictionary",
    "in_path", "address", "credential_word", "assigned", "quoted", "word_before", "word_after", "issued",
)


@dataclass(frozen=True)
class SecretModel:
    """Trees as (feature, threshold, left, right, value) arrays, and the dictionary."""

    trees: tuple
    dictionary: frozenset

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Share of trees that call each row a secret."""
        votes = np.zeros(len(x))
        for feature, threshold, left, right, value in self.trees:
            at = np.zeros(len(x), np.int64)
            while True:
                inner = np.flatnonzero(feature[at] >= 0)
                if not len(inner):
                    break
                node = at[inner]
                low = x[inner, feature[node]] <= threshold[node]
                at[inner] = np.where(low, left[node], right[node])
            votes += value[at]
        return votes / max(len(self.trees), 1)


def candidates(text: str) -> list[tuple[int, int]]:
    """(start, end) in code points, in order and without overlaps; a run within a value is part of it."""
    found = []
    for m in VALUE.finditer(text):
        a, b = m.span("quoted") if m["quoted"] else m.span("bare")
        b = a + len(text[a:b].rstrip(",;\"'`"))
        if m["bare"] and text[a:b][:1] in ("'", '"', "`"):  # a quote that is not closed on its line
            a += 1
        if a < b:
            found.append((a, b))
    if "@" in text:
        found += [m.span(1) for m in LOGIN.finditer(text)]
    found += [m.span() for m in RUN.finditer(text) if DIGIT.search(m.group())]
    out = []
    for a, b in sorted(found, key=lambda v: (v[0], -v[1])):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def describe(text: str, start: int, end: int, dictionary: frozenset) -> list[float]:
    """The features of one candidate, in the order of ``FEATURES``."""
    run, before, after = text[start:end], text[max(0, start - BESIDE) : start], text[end : end + BESIDE]
    n = len(run)
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "s" for c in run]
    counts = np.array([run.count(c) for c in set(run)]) / n
    parts = WORD.findall(run)
    covered = sum(len(p) for p in parts if p.lower() in dictionary)
    left = before.split()
    return [
        float(n),
        kinds.count("d") / n,
        kinds.count("u") / n,
        kinds.count("l") / n,
        sum(c in "0123456789abcdefABCDEF" for c in run) / n,
        sum(a != b for a, b in zip(kinds, kinds[1:])) / n,
        float(-(counts * np.log2(counts)).sum()),
        sum((a in "aeiouAEIOU") != (b in "aeiouAEIOU") for a, b in zip(run, run[1:])) / n,
        covered / n,
        float("/" in run or before.endswith(("/", "\\")) or after.startswith("/")),
        float(bool(ADDRESS.search(before)) or after.startswith(("@", "."))),
        float(any(CREDENTIAL.search(w) for w in left[-3:])),
        float(bool(ASSIGNED.search(before))),
        float(before[-1:] in ("'", '"', "`") and after[:1] in ("'", '"', "`")),
        float(bool(left) and left[-1].strip(".,;:!?").lower() in dictionary),
        float(bool(after.split()) and after.split()[0].strip(".,;:!?").lower() in dictionary),
        float(bool(ISSUED.fullmatch(run))),
    ]


def rule_label(text: str, start: int, end: int) -> bool:
    """Label of a finding where no reviewed one is given: an issued shape, a value that is assigned
    to a word for credentials (but not a bare word of letters behind a colon and a space, which is
    prose), or the password of an address."""
    before = text[max(0, start - 2 * BESIDE) : start]
    if HEADED.search(before):
        return not (text[start:end].rstrip(".!?").isalpha() and before.endswith(": "))
    if text[end : end + 1] == "@" and (user := LOGGED.search(before)):
        return not MAIL.fullmatch(user[1] or "")
    before = before[-BESIDE:]
    return bool(ISSUED.fullmatch(text[start:end]) or (ASSIGNED.search(before) and CREDENTIAL.search(" ".join(before.split()[-3:]))))


def _trees(debug: str) -> tuple:
    """The arrays of each tree, from the model's printed form."""
    out = []
    for tree in re.split(r"\n\s*Tree \d+ [^\n]*:\n", debug)[1:]:
        lines = [x.strip() for x in tree.strip().split("\n")]
        rows, at = [], 0

        def grow() -> int:
            nonlocal at
            me = len(rows)
            rows.append([-1, 0.0, 0, 0, 0.0])
            if lines[at].startswith("Predict:"):
                rows[me][4] = float(lines[at].split(":")[1])
                at += 1
                return me
            found = re.match(r"If \(feature (\d+) <= ([-+0-9.eE]+)\)", lines[at])
            rows[me][0], rows[me][1] = int(found[1]), float(found[2])
            at += 1
            rows[me][2] = grow()
            at += 1  # its Else
            rows[me][3] = grow()
            return me

        grow()
        f, t, a, b, v = zip(*rows)
        out.append((np.array(f), np.array(t), np.array(a), np.array(b), np.array(v)))
    return tuple(out)


#: What every text with a candidate holds, without a search that grows with the square of a run.
DIGIT_RUN, LIKELY = r"[0-9][A-Za-z0-9+/_\-]{3,}", "(?i)" + HEAD + r"\S|:[^\s/:@]*@"


def labelled_findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_documents: int = MAX_DOCUMENTS) -> DataFrame:
    """(id, start, is_secret, text) of rule-labelled findings in at most ``max_documents`` documents
    that hold a candidate. For use where no reviewed findings exist.

    Half of the documents are drawn, by a hash of the id, from those with an assigned or issued value or an
    address, where secrets are, and half from the others, so that both labels are in the sample however
    rare secrets are. Rows with a null id or null text are left out; those that repeat an id come
    with it. An empty table gives no findings."""
    ship(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    likely = F.col("text").rlike(LIKELY) | F.col("text").rlike(ISSUED.pattern)
    held = texts.where("id is not null").select("id", F.xxhash64("id").alias("deal"), likely.alias("likely"), F.col("text").rlike(DIGIT_RUN).alias("run"))
    held = staged(held.where("likely or run").drop("run"), "secret-candidates")
    # of ids and hashes alone; the single task that takes the smallest sees max_documents from each task
    part = lambda stratum: held.where(stratum).orderBy("deal", "id").limit(max_documents // 2).select("id")
    chosen = staged(part("likely").union(part("not likely")).distinct(), "secret-documents")

    def find(column: pa.Array) -> pa.Array:
        return pa.array([[{"start": a, "is_secret": rule_label(t, a, b)} for a, b in candidates(t)] for t in column.to_pylist()], pa.list_(pa.struct([("start", pa.int64()), ("is_secret", pa.bool_())])))

    texts = texts.join(F.broadcast(chosen), "id").where("text is not null")  # bounded by max_documents
    rows = texts.withColumn("f", arrow_udf(find, "array<struct<start:bigint,is_secret:boolean>>").asNondeterministic()("text"))
    return rows.select("id", "text", F.explode("f").alias("f")).select("id", "f.start", "f.is_secret", "text")


def fit_secrets(findings: DataFrame, trees: int = 25, depth: int = 6, max_rows: int = MAX_LABELLED) -> SecretModel | None:
    """The forest fitted on ``findings`` (id, start, is_secret, text), or None without both labels.

    At most ``max_rows`` of them, dealt by a hash of id and start. The dictionary is made of the
    ``MAX_WORDS`` words that most of these findings' texts hold.
    """
    ship(findings.sparkSession)
    rows = findings.where("is_secret is not null and text is not null").withColumn("deal", F.xxhash64("id", "start"))
    cut = rows.select("deal").orderBy("deal").limit(max_rows).agg(F.max("deal")).first()[0]
    if cut is None:
        return None
    rows = staged(rows.where(F.col("deal") <= cut), "secret-findings")
    words = rows.dropDuplicates(["id"]).select(F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))).alias("w"))
    words = words.where(F.length("w") > 1).groupBy("w").count().orderBy(F.desc("count"), "w").limit(MAX_WORDS)
    dictionary = frozenset(r.w for r in words.collect())

    def features(text: pa.Array, start: pa.Array) -> pa.Array:
        out, last, ends = [], None, {}
        for t, a in zip(text.to_pylist(), start.to_pylist()):
            if t != last:
                last, ends = t, dict(candidates(t))
            m = RUN.match(t, a)
            end = ends.get(a) or (m.end() if m else min(a + MIN_LENGTH, len(t)))
            out.append(describe(t, a, end, dictionary) if a < len(t) else [0.0] * len(FEATURES))
        return pa.array(out, pa.list_(pa.float64()))

    x = rows.select(F.col("is_secret").cast("double").alias("label"), array_to_vector(arrow_udf(features, "array<double>")("text", "start")).alias("features"))
    x = staged(x, "secret-features")
    if x.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=11, featureSubsetStrategy="sqrt").fit(x)
    return SecretModel(_trees(forest.toDebugString), dictionary)


FOUND = "struct<findings:array<struct<start:bigint,length:bigint,probability:double,is_secret:boolean>>,redacted:string>"
_KIND = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("probability", pa.float64()), ("is_secret", pa.bool_())]))


def scan_secrets(docs: DataFrame, model: SecretModel | None, text_col: str = "text", result_col: str = "secrets", least: float = MIN_PROBABILITY) -> DataFrame:
    """``docs`` with a struct column ``result_col``: ``findings`` (start and length in code points,
    the forest's probability, the verdict) and ``redacted``, the text with secrets replaced.

    Without a model every candidate is judged by ``rule_label`` and has a null probability. Null
    text has no findings and stays null; empty text has none. Other columns pass through; a
    column already named ``result_col`` is replaced. One map over the rows, no shuffle.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)  # a few thousand nodes and MAX_WORDS words

    def scan(texts: pa.Array) -> pa.Array:
        own, found, clean = shared.value, [], []
        for t in texts.to_pylist():
            spans = candidates(t) if t else []
            if not spans:
                found.append([])
                clean.append(t)
                continue
            if own:
                p = own.probability(np.array([describe(t, a, b, own.dictionary) for a, b in spans])).tolist()
                bad = [v >= least for v in p]
            else:
                p, bad = [None] * len(spans), [rule_label(t, a, b) for a, b in spans]
            found.append([{"start": a, "length": b - a, "probability": v, "is_secret": s} for (a, b), v, s in zip(spans, p, bad)])
            parts, last = [], 0
            for (a, b), s in zip(spans, bad):
                if s:
                    parts += [t[last:a], REDACTED]
                    last = b
            clean.append("".join(parts) + t[last:])
        tidy()
        return pa.StructArray.from_arrays([pa.array(found, _KIND), pa.array(clean, pa.string())], names=["findings", "redacted"])

    return docs.withColumn(result_col, arrow_udf(scan, FOUND).asNondeterministic()(F.col(text_col)))
