"""Quality rules: fixed base measures, and a calibrated logistic regression on hashed n-grams.

The regression sees the relative frequencies of hashed word 1- and 2-grams and character 3- and
4-grams of the raw text. It is fitted by Spark on a bounded sample of labelled documents, its
margins are calibrated on held-out labelled documents (Platt scaling), and all documents are
scored in Arrow batches against a fixed threshold. The base measures use whole texts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import arrow_udf

from panelforge.llm.tables import release, scratch, ship, staged
from panelforge.llm.textops import CONTINUATION, SPACE, U64, WINDOW_FACTORS, mix, pieces, prefix_hash, span_hash, tidy, windows, words

BITS = 15  # of a bucket, for words and characters each
SCALE = 100.0
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
#: Documents pass from this calibrated probability of good quality on: low, as a clean document lost
#: costs more than a poor one kept (poor ones score under 0.11 in 99 of 100 cases on held-out rows).
MIN_PROBABILITY = 0.2
#: Labelled documents that the model is fitted and calibrated on, at most.
MAX_LABELLED = 6000


@dataclass(frozen=True)
class QualityModel:
    """Bucket weights (words first, then characters), bias, and the calibration's two numbers."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * margin + self.shift, -60, 60)))


def _bucket(acc: np.ndarray) -> np.ndarray:
    acc = (acc ^ (acc >> U64(29))) * U64(0x9E3779B97F4A7C15)
    return (acc >> U64(64 - BITS)).astype(np.int64)


def _gram_buckets(data, offsets, word_hash, first):
    """For each family of n-grams: (buckets by place, first place, number of places of each text)."""
    heads = np.flatnonzero(~CONTINUATION[data])
    ends = np.append(heads[1:], len(data))
    code = data[heads].astype(U64)
    for j in (1, 2, 3):
        at = np.flatnonzero(heads + j < ends)
        code[at] |= data[heads[at] + j].astype(U64) << U64(8 * j)
    char_first = np.searchsorted(heads, offsets)
    for items, begin, orders, shift in ((word_hash, first, (1, 2), 0), (code, char_first, (3, 4), 1 << BITS)):
        for n in orders:
            acc = items * WINDOW_FACTORS[0]
            for j in range(1, n):
                acc[: len(items) - j] += items[j:] * WINDOW_FACTORS[j]
            yield _bucket(acc + U64(n)) + shift, begin[:-1], np.maximum(np.diff(begin) - n + 1, 0), shift


def _repeated(runs: np.ndarray, k: int) -> int:
    """Items covered by runs of ``k`` that occur twice or more."""
    s = np.sort(runs)
    if len(s) < 2 or not (s[1:] == s[:-1]).any():
        return 0
    _, inverse, counts = np.unique(runs, return_inverse=True, return_counts=True)
    twice = np.flatnonzero(counts[inverse] > 1)
    cover = np.zeros(len(runs) + k, np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + k, -1)
    return int((np.cumsum(cover) > 0).sum())


def _duplicate_lines(data, offsets, sums) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text, for each text."""
    docs = len(offsets) - 1
    at = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([offsets[:-1], at + 1]))
    doc = np.searchsorted(offsets[1:], starts, "right")
    keep = doc < docs
    starts, doc = starts[keep], doc[keep]
    # a line ends at its newline or with its text
    stop = np.append(at, len(data))[np.searchsorted(at, starts)]
    ends = np.minimum(stop, offsets[1:][doc])
    seen = np.concatenate([[0], np.cumsum(~SPACE[data])])
    full = seen[ends] > seen[starts]
    starts, ends, doc = starts[full], ends[full], doc[full]
    key = mix(span_hash(sums, starts, ends) + mix(doc.astype(U64) + U64(1)))
    _, once = np.unique(key, return_index=True)
    return np.bincount(doc, minlength=docs) - np.bincount(doc[once], minlength=docs)


def measures(texts: pa.Array, model: QualityModel | None) -> dict[str, np.ndarray]:
    """Base measures and the model's margin (nan without a model) of each text."""
    out: dict[str, list] = {k: [] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "margin")}
    for row, end, data, offsets in pieces(texts):
        starts, ends, first = words(data, offsets)
        sums = prefix_hash(data)
        h = span_hash(sums, starts, ends)
        runs, run_first = windows(h, first, WINDOW)
        sized = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[offsets])
        out["n_words"].append(np.diff(first))
        out["word_chars"].append(sized(~SPACE[data] & ~CONTINUATION[data]))
        out["n_symbols"].append(sized(SYMBOLS[data]))
        out["n_dup_lines"].append(_duplicate_lines(data, offsets, sums))
        out["n_repeat_words"].append(np.array([_repeated(runs[run_first[i] : run_first[i + 1]], WINDOW) for i in range(end - row)], np.int64))
        if model is None:
            out["margin"].append(np.full(end - row, np.nan))
            continue
        margin = np.full(end - row, model.bias)
        total, seen, family = np.zeros(end - row), np.zeros(end - row), 0
        for bucket, begin, count, shift in _gram_buckets(data, offsets, h, first):
            if shift != family:
                margin += SCALE * total / np.maximum(seen, 1)
                total, seen, family = np.zeros(end - row), np.zeros(end - row), shift
            w = np.concatenate([[0.0], np.cumsum(model.weights[bucket])])
            total += w[begin + count] - w[begin]
            seen += count
        out["margin"].append(margin + SCALE * total / np.maximum(seen, 1))
    kinds = {"margin": np.float64}
    return {k: np.concatenate(v) if v else np.zeros(0, kinds.get(k, np.int64)) for k, v in out.items()}


def features(texts: pa.Array) -> pa.Array:
    """Sparse features of each text: struct of sorted bucket indices and scaled frequencies."""
    index, value = [], []
    for row, end, data, offsets in pieces(texts):
        starts, ends, first = words(data, offsets)
        h = span_hash(prefix_hash(data), starts, ends)
        grams = list(_gram_buckets(data, offsets, h, first))
        for i in range(end - row):
            idx, val = [], []
            for shift in (0, 1 << BITS):
                own = [b[f[i] : f[i] + c[i]] for b, f, c, s in grams if s == shift]
                both = np.concatenate(own)
                u, n = np.unique(both, return_counts=True)
                idx.append(u)
                val.append(n * (SCALE / max(len(both), 1)))
            index.append(np.concatenate(idx).astype(np.int32))
            value.append(np.concatenate(val))
    tidy("powers")
    kinds = [pa.field("i", pa.list_(pa.int32())), pa.field("v", pa.list_(pa.float64()))]
    return pa.StructArray.from_arrays([pa.array(index, kinds[0].type), pa.array(value, kinds[1].type)], fields=kinds)


def _platt(margin: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the calibrated probability, by Newton steps on smoothed targets."""
    pos, neg = good.sum(), (1 - good).sum()
    target = np.where(good > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -60, 60)))
        g = np.array([((p - target) * margin).sum(), (p - target).sum()])
        w = p * (1 - p) + 1e-9
        hess = np.array([[(w * margin**2).sum() + 1e-6, (w * margin).sum()], [(w * margin).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(hess, g)
        a, b = a - float(np.clip(step[0], -1, 1)), b - float(np.clip(step[1], -1, 1))
        if abs(step).max() < 1e-9:
            break
    return (a, b) if a > 0 else (1.0, 0.0)


def labelled_sample(docs, labels, id_col="doc_id", text_col="text", label_col="quality", max_rows=MAX_LABELLED) -> DataFrame:
    """(id, good, held_out, text) of at most ``max_rows`` labelled documents, dealt by a hash of the id.

    Labels other than 0 and 1 and documents with contradicting labels are left out.
    """
    votes = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("double").alias("good")).where("good in (0, 1)")
    votes = votes.groupBy("id").agg(F.min("good").alias("good"), F.max("good").alias("most")).where("good = most")
    votes = votes.select("id", "good", F.xxhash64("id").alias("deal")).orderBy("deal", "id").limit(max_rows)
    votes = staged(votes.select("id", "good", (F.pmod("deal", F.lit(4)) == 0).alias("held_out")), "quality-labels")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return texts.join(F.broadcast(votes), "id")  # bounded by max_rows


def fit_quality(docs, labels, id_col="doc_id", text_col="text", label_col="quality", max_rows=MAX_LABELLED) -> QualityModel | None:
    """The model fitted on labelled documents, or None where they don't show both qualities (as in
    empty tables). Null ids and labels of no document play no part; a null text counts as empty; rows
    that repeat an id are a sample each."""
    spark = docs.sparkSession
    ship(spark)
    sample = labelled_sample(docs, labels, id_col, text_col, label_col, max_rows)
    sample = sample.select("good", "held_out", arrow_udf(features, "struct<i:array<int>,v:array<double>>")("text").alias("f"))
    sample = staged(sample, "quality-sample", "zstd")
    shares = {r.good: r["count"] for r in sample.where("not held_out").groupBy("good").count().collect()}
    if len(shares) < 2:
        return None

    def vectors(part: str) -> DataFrame:
        """(label, features) of a part of the sample, as Spark reads sparse vectors from text."""
        path = scratch(spark, "quality-vectors")
        entries = F.zip_with("f.i", "f.v", lambda i, v: F.concat((i + 1).cast("string"), F.lit(":"), v.cast("float").cast("string")))
        line = F.concat_ws(" ", F.col("good").cast("string"), entries)
        # few files: each step of the fit sends a weight for each n-gram from each of them
        sample.where(part).select(line).coalesce(FIT_TASKS).write.option("compression", "gzip").text(path)
        return spark.read.format("libsvm").option("numFeatures", str(2 << BITS)).load(path)

    weigh = F.when(F.col("label") > 0, sum(shares.values()) / (2 * shares[1.0])).otherwise(sum(shares.values()) / (2 * shares[0.0]))
    lr = LogisticRegression(weightCol="weight", regParam=1e-4, standardization=False, maxIter=40)
    found = lr.fit(vectors("not held_out").withColumn("weight", weigh))
    release(spark)
    weights, bias = found.coefficients.toArray(), float(found.intercept)
    held = found.transform(vectors("held_out")).select(F.col("label").alias("good"), "rawPrediction").collect()  # at most max_rows numbers
    margin, good = np.array([r.rawPrediction[1] for r in held]), np.array([r.good for r in held])
    slope, shift = _platt(margin, good) if 0 < good.sum() < len(good) else (1.0, 0.0)
    return QualityModel(weights, bias, slope, shift)


#: Tasks of the fit, whose input is bounded.
FIT_TASKS = 4

RESULT = "struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,base_failed:boolean,p_good:double,kept:boolean>"


def _verdict_udf(spark, model: QualityModel | None, least: float):
    shared = spark.sparkContext.broadcast(model)  # 2^(BITS + 1) numbers

    def verdict(texts: pa.Array) -> pa.Array:
        own = shared.value
        m = measures(texts, own)
        failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])
        p = own.probability(m["margin"]) if own else np.full(len(failed), math.nan)
        good = ~failed & ((p >= least) if own else True)
        columns = {k: pa.array(m[k]) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
        tidy("powers")
        columns |= {"base_failed": pa.array(failed), "p_good": pa.array(p, mask=np.isnan(p)), "kept": pa.array(good)}
        return pa.StructArray.from_arrays(list(columns.values()), names=list(columns))

    return arrow_udf(verdict, RESULT).asNondeterministic()


def quality_rules(docs: DataFrame, model: QualityModel | None, text_col: str = "text", result_col: str = "quality", least: float = MIN_PROBABILITY) -> DataFrame:
    """``docs`` with a struct column ``result_col``: the base measures, ``p_good`` and ``kept``.

    ``kept`` is false where a base rule fails, else whether the calibrated probability reaches
    ``least``; without a model the base rules alone decide and ``p_good`` is null. Null text
    counts as empty (no words: a base rule fails). Other columns pass through untouched, and a
    column that is already named ``result_col`` is replaced. One map over the rows, no shuffle.
    """
    ship(docs.sparkSession)
    return docs.withColumn(result_col, _verdict_udf(docs.sparkSession, model, least)(F.col(text_col)))
