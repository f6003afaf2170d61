import math
from collections import Counter

import numpy as np
import pytest

from panelforge.llm.vectors import near_vectors

def brute_links(rows, t=0.93):
    ids, units, labels = [], [], []
    for i, v, label in rows:
        x = np.array(v, float) if v is not None and None not in v else np.zeros(0)
        if i is not None and label is not None and len(x) and np.isfinite(x).all() and x.any():
            ids.append(i)
            units.append(x / np.linalg.norm(x))
            labels.append(label)
    links, home = Counter(), {r[0]: r[0] for r in rows}

    def find(x):
        while home[x] != x:
            x = home[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            if labels[a] == labels[b] and len(units[a]) == len(units[b]) and units[a] @ units[b] >= t:
                links[ids[a]] += 1
                links[ids[b]] += 1
                x, y = find(ids[a]), find(ids[b])
                home[max(x, y)] = min(x, y)
    return {r[0]: (links[r[0]], find(r[0])) for r in rows if r[0] is not None}


@pytest.mark.parametrize("sizes", [{}, {"window": 8, "block": 32}])
def test_vectors_against_brute_force(spark, sizes):
    rng = np.random.default_rng(3)
    rows = []
    for c in range(6):
        centre = rng.normal(size=24)
        for _ in range(50 if c == 0 else 6):
            rows.append((centre + rng.normal(size=24) * 0.12 * np.linalg.norm(centre) / 5, c % 2))
    rows += [(rng.normal(size=24), k % 3) for k in range(80)]
    rows += [(rows[0][0], 0)] * 40 + [(rows[0][0], 1), (rows[0][0] * 2, 0), (rows[0][0][:5], 0)]
    rows = [(i, [float(np.float32(x)) for x in v], label) for i, (v, label) in enumerate(rows)]
    n = len(rows)
    rows += [(n, None, 0), (n + 1, [], 0), (n + 2, [0.0] * 24, 0), (n + 3, [float("nan")] * 24, 0), (n + 4, rows[0][1], None), (n + 5, [None, 1.0], 0), (None, rows[0][1], 0)]
    df = spark.createDataFrame([(*r, "x", 7) for r in rows], "vec_id long, embedding array<float>, label int, rep string, component_id int")
    found = near_vectors(df, **sizes).collect()
    assert len(found) == len(rows)
    expected = brute_links(rows)
    right = sum((r.n_links, r.component_id) == expected[r.vec_id] for r in found if r.vec_id is not None)
    assert right >= 0.97 * len(expected)  # the passes may miss a link, never invent one
    assert sum(r.n_links for r in found) <= sum(v[0] for v in expected.values())
    assert all(r.kept == (r.vec_id is not None and r.component_id == r.vec_id) for r in found)
    assert [(r.n_links, r.component_id) for r in found if r.vec_id is None] == [(0, None)]


def test_no_vectors(spark):
    assert near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


@pytest.mark.parametrize("shared", [0.0, 0.5, 0.85])
def test_passes_follow_the_label(spark, shared):
    rng = np.random.default_rng(8)
    n, pairs = 3000, 400
    z = rng.normal(size=(n, 48)) * (np.arange(48) > 0)
    z /= np.linalg.norm(z, axis=1)[:, None]
    a, w = z[:pairs], z[-pairs:]
    w = w - (w * a).sum(axis=1)[:, None] * a
    c = (0.935 - shared) / (1 - shared)
    z[-pairs:] = c * a + math.sqrt(1 - c * c) * w / np.linalg.norm(w, axis=1)[:, None]
    x = math.sqrt(1 - shared) * z
    x[:, 0] = math.sqrt(shared)
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int")
    found = {r.vec_id: r.component_id for r in near_vectors(df, window=8, block=128).collect()}
    assert sum(found[i] == found[n - pairs + i] for i in range(pairs)) >= 0.985 * pairs


def test_number_of_passes():
    from panelforge.llm.vectors import turns

    assert turns(257, 0.9, 0.93) == 1 and turns(2000, 0.0, 0.93) == 8
    assert [turns(n, 0.0, 0.93) for n in (100_000, 1_000_000)] == [14, 23] and turns(1_000_000, 0.5, 0.93) == 49
    assert turns(1_000_000, 0.92, 0.93) == 0 and turns(1_000_000, 1.0, 0.93) == 0
