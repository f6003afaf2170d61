"""Random inputs against brute-force Python: the operators must agree on every example."""

from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from panelforge.operators.conflict import conflict_aggregate
from panelforge.operators.reshape import explode_periods, unpivot_monthly

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))

small_int = st.one_of(st.none(), st.integers(0, 3))
small_str = st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))
row = st.tuples(small_int, small_int, small_str, small_int)


@SETTINGS
@given(data=st.lists(row, min_size=0, max_size=40), pieces=st.sampled_from([1, 2, 5]))
def test_conflict_matches_brute_force(spark, data, pieces):
    df = spark.createDataFrame(data, "k1 int, k2 int, v string, w int")
    out = [r.asDict() for r in conflict_aggregate(df, ["k1", "k2"], pieces=pieces).collect()]

    groups = defaultdict(list)
    singles = Counter()
    for k1, k2, v, w in data:
        if k1 is None or k2 is None:
            singles[(k1, k2, v, w)] += 1
        else:
            groups[(k1, k2)].append((v, w))

    got_groups = defaultdict(list)
    got_singles = Counter()
    for r in out:
        assert len(r["v"]) == len(r["w"]) >= 1
        key = (r["k1"], r["k2"])
        if None in key:
            assert len(r["v"]) == 1
            assert r["n_distinct_v"] == (0 if r["v"][0] is None else 1)
            got_singles[(r["k1"], r["k2"], r["v"][0], r["w"][0])] += 1
            continue
        rows_ = groups[key]
        assert r["n_distinct_v"] == len({v for v, _ in rows_ if v is not None})
        assert r["n_distinct_w"] == len({w for _, w in rows_ if w is not None})
        assert key not in got_groups  # one row for each key
        got_groups[key].extend(zip(r["v"], r["w"]))
    assert got_singles == singles
    assert set(got_groups) == set(groups)
    for key, rows_ in groups.items():
        assert Counter(got_groups[key]) == Counter(rows_)


@SETTINGS
@given(
    arrays=st.lists(st.one_of(st.none(), st.lists(small_int, max_size=6)), min_size=1, max_size=8),
    n=st.integers(1, 7),
)
def test_explode_matches_brute_force(spark, arrays, n):
    df = spark.createDataFrame([(i, a) for i, a in enumerate(arrays)], "id int, a array<int>")
    got = sorted((r["id"], r["month"], r["a"]) for r in explode_periods(df, "month", n).collect())
    want = sorted(
        (i, p, (a[p - 1] if a is not None and p <= len(a) else None)) for i, a in enumerate(arrays) for p in range(1, n + 1)
    )
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert got == sorted(want, key=lambda t: (t[0], t[1]))


@SETTINGS
@given(
    present=st.sets(st.tuples(st.sampled_from(["x", "y"]), st.integers(1, 5)), min_size=1, max_size=8),
    n=st.integers(1, 4),
    values=st.lists(small_int, min_size=10, max_size=10),
)
def test_unpivot_matches_brute_force(spark, present, n, values):
    cols = sorted(present)
    names = [f"{b}_mo_{m:02d}" for b, m in cols]
    vals = [values[i % len(values)] for i in range(len(cols))]
    df = spark.createDataFrame([tuple([7] + vals)], "id int, " + ", ".join(f"{c} int" for c in names))
    out = unpivot_monthly(df, n_periods=n)
    bases = list(dict.fromkeys(b for b, _ in cols))
    assert out.columns == ["id", "month"] + bases
    got = sorted(tuple(r) for r in out.collect())
    lookup = {(b, m): v for (b, m), v in zip(cols, vals)}
    want = sorted(tuple([7, p] + [lookup.get((b, p)) for b in bases]) for p in range(1, n + 1))
    assert got == want
