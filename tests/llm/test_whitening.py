import math

import numpy as np
import pytest

from panelforge.llm import whitening
from panelforge.llm.queries import op12_whitening
from panelforge.llm.whitening import Spectrum, rank_one, secular_roots, whitened_rows

SF = "/root/testdata/sf0.01"
NAN, INF = float("nan"), float("inf")


def brute(rows, k=4):
    """(vec_id, component) rows by numpy, from (vec_id, vector) pairs."""
    keep = [(i, [math.floor(256 * float(c)) + 0 for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in keep})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[j] for x in fit) for j in range(d)]
    centred = np.array(fit, float) - np.array(sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = []
    for i, x in keep:
        y = (np.array(x, float) - np.array(sums) / n) @ vectors
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        out += [(i, j + 1, n, deviation, y[j] / math.sqrt(values[j]), values[j] / values.sum()) for j in range(min(k, d)) if values[j] > 1e-12 * values.sum()]
    return out


def compare(found, expected):
    """Equal but for each component's sign, which is one for all rows."""
    key = lambda r: (r[1], r[0] is not None, r[0] or 0, abs(r[4]))
    found, expected = sorted(map(tuple, found), key=key), sorted(expected, key=key)
    assert len(found) == len(expected)
    signs = {}
    for got, want in zip(found, expected):
        assert got[:4] == want[:4]
        assert got[5] == pytest.approx(want[5], rel=1e-10)
        assert got[6] < 1e-10
        assert abs(abs(got[4]) - abs(want[4])) < 1e-8
        if abs(want[4]) > 1e-6:
            assert signs.setdefault(want[1], got[4] * want[4] > 0) == (got[4] * want[4] > 0)


def test_whole_table(spark, monkeypatch):
    monkeypatch.setattr(whitening, "VECTORS_EACH", 30)  # many states, two tiers
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    compare(op12_whitening(spark, SF).collect(), brute(rows))


def test_odd_vectors(spark):
    r = np.random.default_rng(4)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(r.normal(size=(40, 5)) * [3, 2, 1, 0.5, 0.2])]
    rows += [(5, rows[5][1]), (None, rows[6][1]), (100, rows[7][1]), (101, None), (102, []), (103, [1.0, None, 0.0, 0.0, 0.0])]
    rows += [(104, [NAN] * 5), (105, [INF, 0.0, 0.0, 0.0, 0.0]), (106, [-0.0] * 5), (107, [0.0] * 5)]
    df = spark.createDataFrame([(*row, 1, 2.0) for row in rows], "vec_id long, embedding array<double>, n int, whitened double")
    compare(whitened_rows(df).collect(), brute(rows))


def test_few_dimensions_without_variance_and_no_vectors(spark):
    line = [(i, [float(i), 2.0 * i, 5.0]) for i in range(10)]
    schema = "vec_id long, embedding array<double>"
    compare(whitened_rows(spark.createDataFrame(line, schema)).collect(), brute(line))
    assert {r.component for r in whitened_rows(spark.createDataFrame(line, schema)).collect()} == {1}
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]):
        assert whitened_rows(spark.createDataFrame(rows, schema)).collect() == []


def test_lengths_that_differ_are_an_error(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0, 3.0])]
    with pytest.raises(Exception, match="different lengths"):
        whitened_rows(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()


def test_deviations_beyond_a_long_are_null(spark):
    rows = [(i, [2.0**40 * i, 1.0 + i * i]) for i in range(5)]
    found = whitened_rows(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    expected = {r[0]: r[3] for r in brute(rows)}
    assert all(r.deviation == (expected[r.vec_id] if expected[r.vec_id] < 2**63 else None) for r in found)
    assert any(r.deviation is None for r in found)


@pytest.mark.parametrize("kind", ["plain", "repeated", "flat", "scaled", "clusters"])
def test_updates_and_combination_against_eigh(kind):
    r = np.random.default_rng(7)
    x = np.floor(r.normal(size=(400, 12)) * 60)
    if kind == "repeated":
        x[:300] = x[0]
    if kind == "flat":
        x[:, 4:] = 7
    if kind == "scaled":
        x = np.floor(x * 10.0 ** -np.arange(12)) * 1e6
    if kind == "clusters":
        x = np.round(r.normal(size=(4, 12)) * 1000)[r.integers(0, 4, 400)] + r.integers(0, 2, (400, 12))
    scatter = (x - x.mean(0)).T @ (x - x.mean(0))
    scale = np.abs(scatter).max()
    half = [Spectrum.empty(12), Spectrum.empty(12), Spectrum.empty(12)]
    for i, v in enumerate(x):
        half[0].add(v)
        half[1 + (i % 3 == 0)].add(v)
    half[1].combine(half[2])
    for s in half[:2]:
        assert np.abs(s.vectors.T @ s.vectors - np.eye(12)).max() < 1e-11
        assert np.abs(s.vectors * s.values @ s.vectors.T - scatter).max() < 1e-11 * scale
        assert np.abs(s.mean - x.mean(0)).max() < 1e-9 * np.abs(x).max()


def test_roots_near_their_poles():
    d = np.array([0.0, 1.0, 1.0 + 1e-9, 2.0, 1e6])
    for z2 in ([1e-18, 1, 1, 1e-12, 1], [1, 1e-14, 1e-14, 1, 1e-20], [1] * 5):
        away, roots = secular_roots(d, np.array(z2, float), 0.7)
        assert (np.diff(roots) > 0).all() and (roots >= d).all() and (roots[:-1] <= d[1:]).all()
        assert (np.sign(away) == np.where(np.arange(5)[None, :] <= np.arange(5)[:, None], 1, -1)).all()


def test_an_update_of_nothing_changes_nothing():
    values, vectors = rank_one(np.array([1.0, 2.0]), np.eye(2), 1.0, np.zeros(2))
    assert values.tolist() == [1.0, 2.0] and vectors.tolist() == np.eye(2).tolist()
