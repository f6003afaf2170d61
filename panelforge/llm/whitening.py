"""Whitening of embeddings by incremental eigendecomposition.

Entries c become whole numbers floor(256 c); the fit runs over the distinct vectors of these.

1. *Partitions.* Each task keeps the count, mean and spectrum (eigenvalues, eigenvectors) of the
   centred scatter matrix of its vectors. A vector x adds the rank-one matrix n/(n+1) (x-m)(x-m)^T; the new
   eigenvalues are the roots of its secular equation, one between each two old ones. Eigenvalues that
   coincide (mixed by a reflection first) and directions without a part in the update are deflated:
   they stay as they are. The eigenvectors follow from the vector for which the found
   roots are exact, so they stay orthogonal however close the roots are.
2. *Combination.* Two spectra are combined by one rank-one update for each eigenvalue of the second and
   one for the difference of the means, in a tree of ``FAN`` states a task.
3. *Refinement.* A Rayleigh-Ritz step: the fit list, centred by the exact mean, is projected on the
   combined basis (all dimensions), the tasks' products are summed, and the small matrix's eigenvectors
   turn the basis into eigenvectors to double precision. Another pass measures the covariance
   of the whitened fit list.

A state holds d^2 numbers for d dimensions, whatever the number of vectors; the driver sees one.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from panelforge.functions.names import quote
from panelforge.llm.tables import parts, ship, staged

#: Entries are counted in units of 1 / SCALE.
SCALE = 256
COMPONENTS = 4
#: Vectors that one task adds to its spectrum, and states that one task combines.
VECTORS_EACH, FAN = 20_000, 16
#: Variance, as part of the whole, below which a direction counts as having none.
NO_VARIANCE = 1e-12
EPS = np.finfo(float).eps


def units(vector: Column) -> Column:
    """floor(256 c) of the entries as longs; null for a vector that is null, empty, or holds null, NaN,
    infinite entries or such as no long can hold."""
    c = lambda x: x.cast("double") * F.lit(float(SCALE))
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(c(x)) >= F.lit(2.0**62)))
    return F.when(vector.isNotNull() & (F.size(vector) > 0) & ~odd, F.transform(vector, lambda x: F.floor(c(x)).cast("long")))


def secular_roots(d: np.ndarray, z2: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + rho sum(z2 / (d - x)) = 0 for ascending distinct ``d`` and positive ``z2``, ``rho``: the
    differences root_j - d_i (a matrix, accurate even where root and pole nearly meet) and the roots.

    Root j lies between d_j and d_j+1. It is found relative to the nearer pole, by interpolation with
    both poles, which falls back to halving the bracket."""
    k = len(d)
    width = np.append(np.diff(d), rho * z2.sum())
    rows = np.arange(k)
    half = width / 2
    at_half = 1 + rho * (z2 / (d[None, :] - d[:, None] - half[:, None])).sum(1)
    right = (at_half < 0) & (rows < k - 1)
    origin = rows + right
    delta = d[None, :] - d[origin][:, None]
    lo, hi = np.where(right, -half, 0.0), np.where(right, 0.0, np.where(rows < k - 1, half, width))
    tau = (lo + hi) / 2
    below = rows[None, :] <= rows[:, None]
    p1, p2 = delta[rows, rows], np.append(delta[rows[:-1], rows[1:]], 0.0)
    inner = rows < k - 1
    with np.errstate(all="ignore"):
        for _ in range(80):
            gap = delta - tau[:, None]
            r = z2 / gap
            f, noise = 1 + rho * r.sum(1), k * (1 + rho * np.abs(r).sum(1))
            r /= gap
            slope = rho * r.sum(1)
            done = np.abs(f) <= 4 * EPS * (noise + slope * np.abs(tau))
            if done.all():
                break
            lo, hi = np.where(f < 0, tau, lo), np.where(f > 0, tau, hi)
            low = rho * (r * below).sum(1)
            a1, a2 = p1 - tau, p2 - tau
            c = f - a1 * low - a2 * (slope - low)
            a, b = (a1 + a2) * f - a1 * a2 * slope, a1 * a2 * f
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            last = slope * tau * tau / (f + slope * tau)  # one pole only: c - s / x through value and slope
            new = np.where(inner, tau + step, last)
            tau = np.where(done, tau, np.where((new > lo) & (new < hi), new, (lo + hi) / 2))
    return tau[:, None] - delta, d[origin] + tau


def rank_one(values: np.ndarray, vectors: np.ndarray, rho: float, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum of vectors diag(values) vectors^T + rho v v^T; ascending ``values``, ``rho`` >= 0."""
    z = vectors.T @ v
    norm2 = float(z @ z)
    if not rho * norm2 > 0:
        return values, vectors
    tol = 8 * EPS * max(float(values[-1]), rho * norm2)
    start = np.flatnonzero(np.append(True, np.diff(values) > tol))
    sizes = np.diff(np.append(start, len(values)))
    for a, g in zip(start[sizes > 1], sizes[sizes > 1]):  # equal eigenvalues: one direction takes the update
        part = z[a : a + g]
        length = math.sqrt(float(part @ part))
        if length > 0:
            w = part.copy()
            w[-1] += math.copysign(length, w[-1])
            block = vectors[:, a : a + g]
            vectors[:, a : a + g] = block - np.outer(block @ w, (2 / float(w @ w)) * w)
            z[a : a + g - 1], z[a + g - 1] = 0.0, -math.copysign(length, part[-1])
    live = np.flatnonzero(rho * np.abs(z) * math.sqrt(norm2) > tol)
    if not len(live):
        return values, vectors
    d, zl = values[live], z[live]
    k = len(d)
    away, roots = secular_roots(d, zl * zl, rho)
    gaps = d[:, None] - d[None, :]  # the vector for which the roots are exact (Gu and Eisenstat)
    pole = np.ones((k, k))
    pole[:-1] = np.where(np.arange(k)[None, :] > np.arange(k - 1)[:, None], gaps[:-1], gaps[1:])
    exact = np.copysign(np.sqrt(np.abs(np.prod(away / pole, axis=0))), zl)
    turn = exact[:, None] / -away.T
    turn /= np.sqrt((turn * turn).sum(0))
    values, vectors = values.copy(), vectors.copy()
    values[live], vectors[:, live] = roots, vectors[:, live] @ turn
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


@dataclass
class Spectrum:
    """Count, exact sums, mean and the spectrum of the centred scatter matrix of some vectors."""

    n: int
    sums: list[int]
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, dims: int) -> Spectrum:
        return cls(0, [0] * dims, np.zeros(dims), np.zeros(dims), np.eye(dims))

    def add(self, x: np.ndarray) -> None:
        v = x - self.mean
        self.values, self.vectors = rank_one(self.values, self.vectors, self.n / (self.n + 1), v)
        self.n += 1
        self.mean = self.mean + v / self.n

    def combine(self, other: Spectrum) -> None:
        if not other.n:
            return
        if len(self.mean) != len(other.mean):
            raise ValueError(f"vectors of different lengths: {sorted((len(self.mean), len(other.mean)))}")
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, float(value), vector)
        n = self.n + other.n
        apart = other.mean - self.mean
        self.values, self.vectors = rank_one(self.values, self.vectors, self.n * other.n / n, apart)
        self.mean = self.mean + apart * (other.n / n)
        self.n, self.sums = n, [a + b for a, b in zip(self.sums, other.sums)]

    SCHEMA = "part bigint, n bigint, sums array<decimal(38,0)>, mean array<double>, values array<double>, vectors array<double>"

    def table(self, part: int) -> pa.Table:
        doubles = [pa.array([x.ravel()], pa.list_(pa.float64())) for x in (self.mean, self.values, self.vectors)]
        sums = pa.array([[Decimal(s) for s in self.sums]], pa.list_(pa.decimal128(38, 0)))
        return pa.table([pa.array([part]), pa.array([self.n]), sums, *doubles], ["part", "n", "sums", "mean", "values", "vectors"])

    @classmethod
    def read(cls, row: dict) -> Spectrum:
        mean = np.array(row["mean"])
        return cls(row["n"], [int(s) for s in row["sums"]], mean, np.array(row["values"]), np.array(row["vectors"]).reshape(len(mean), -1))


def merge_spectra(rows: Iterator[dict], part: int) -> pa.Table:
    total = Spectrum.read(next(rows))
    for row in rows:
        total.combine(Spectrum.read(row))
    return total.table(part)


def merge_sums(rows: Iterator[dict], part: int) -> pa.Table:
    return sum_table(sum(np.array(row["total"]) for row in rows), part)


SUM_SCHEMA = "part bigint, total array<double>"


def sum_table(total: np.ndarray, part: int) -> pa.Table:
    return pa.table([pa.array([part]), pa.array([total.ravel()], pa.list_(pa.float64()))], ["part", "total"])


def tree(states: DataFrame, merge: Callable[[Iterator[dict], int], pa.Table], label: str) -> dict | None:
    """The one state that ``merge`` makes of all rows of ``states`` (each of another ``part``), ``FAN`` of
    them a task, tier by tier; None without any."""
    states = staged(states, label)

    def join(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("part")  # the same sum whichever task ends first
        found = ({c: v.values.to_numpy(zero_copy_only=False) if isinstance(v, pa.ListScalar) else v.as_py() for c, v in zip(rows.column_names, map(lambda c: c[i], rows.columns))} for i in range(len(rows)))
        return merge(found, key[0].as_py())

    while states.count() > 1:
        key = F.expr(f"part div {FAN}")
        states = staged(states.groupBy(key.alias("key")).applyInArrow(join, states.schema), label)
    rows = states.collect()
    return rows[0].asDict() if rows else None


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of longs as a matrix; lists of several lengths are an error."""
    flat, sizes = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
    if len(sizes) and (sizes != sizes[0]).any():
        raise ValueError(f"vectors of different lengths: {sorted(set(sizes.tolist()))}")
    return flat.reshape(len(sizes), -1)


@dataclass
class Whitening:
    """``n`` distinct vectors with exact ``sums``, their ``mean``; ``components`` (columns) by falling
    ``eigenvalues`` of their covariance (divisor n), its ``trace``, and ``identity_error``: the largest
    entry of the whitened covariance less the identity."""

    n: int
    sums: list[int]
    mean: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float = 0.0

    def project(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.components / np.sqrt(self.eigenvalues)


def _products(fit: DataFrame, mapped: Callable[[np.ndarray], np.ndarray], label: str) -> np.ndarray:
    """Sum of y y^T over the vectors y = mapped(x) of the fit list."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                y = mapped(matrix(batch.column("x")).astype(float))
                total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            yield from sum_table(total, TaskContext.get().partitionId()).to_batches()

    total = np.array(tree(fit.mapInArrow(add, SUM_SCHEMA), merge_sums, label)["total"])
    return total.reshape(math.isqrt(len(total)), -1)


def fit_whitening(x: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening fitted to the distinct vectors of ``x``'s array column ``x`` (longs; nulls are left out).

    None without a vector. A direction without variance (below ``NO_VARIANCE`` of the whole) is no
    component, so there may be fewer than asked for, none with a single vector."""
    spark = x.sparkSession
    ship(spark)
    fit = staged(x.where("x is not null").select("x").distinct(), "whitening-fit")
    wanted = parts(spark, fit.count(), VECTORS_EACH)
    fit = staged(fit.repartition(wanted), "whitening-fit")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            rows = matrix(batch.column("x"))
            if not len(rows):
                continue
            state = state or Spectrum.empty(rows.shape[1])
            safe = int(np.abs(rows).max()) * len(rows) < 2**62
            sums = rows.sum(0) if safe else rows.astype(object).sum(0)
            state.sums = [a + int(b) for a, b in zip(state.sums, sums)]
            for v in rows.astype(float):
                state.add(v)
        if state:
            yield from state.table(TaskContext.get().partitionId()).to_batches()

    found = tree(fit.mapInArrow(add, Spectrum.SCHEMA), merge_spectra, "whitening-spectra")
    if found is None:
        return None
    whole = Spectrum.read(found)
    mean = np.array([s / whole.n for s in whole.sums])  # the exact sums' quotients, correctly rounded
    basis = np.linalg.qr(whole.vectors[:, ::-1])[0]
    small = _products(fit, lambda y: (y - mean) @ basis, "whitening-ritz") / whole.n
    values, turn = np.linalg.eigh(small)
    trace = float(np.trace(small))
    pick = [i for i in range(len(values) - 1, -1, -1) if values[i] > NO_VARIANCE * trace][:components]
    model = Whitening(whole.n, whole.sums, mean, basis @ turn[:, pick], values[pick], trace)
    if pick:
        model.components /= np.sqrt((model.components**2).sum(0))
        model.identity_error = float(np.abs(_products(fit, model.project, "whitening-check") / whole.n - np.eye(len(pick))).max())
    return model


def deviations(model: Whitening, x: np.ndarray) -> list[int | None]:
    """sum((n x - sums)^2) of each row, exact; null where a long can't hold it."""
    most = model.n * int(np.abs(x).max(initial=0)) + max(map(abs, model.sums))
    exact = np.int64 if most**2 * x.shape[1] < 2**63 else object
    y = x.astype(exact) * model.n - np.array(model.sums, dtype=exact)
    return [int(v) if v < 2**63 else None for v in (y * y).sum(1)]


def whiten(df: DataFrame, model: Whitening, x_col: str = "x", result_col: str = "whitening") -> DataFrame:
    """``df`` with a struct ``result_col``: ``deviation`` and ``whitened``, one number for each component;
    null where ``x_col`` (longs) is null. Other columns pass through; a map over the rows."""
    ship(df.sparkSession)

    def each(column: pa.Array) -> pa.Array:
        known = column.drop_null()
        x = matrix(known) if len(known) else np.zeros((0, len(model.mean)), np.int64)
        if x.shape[1] != len(model.mean):
            raise ValueError(f"vectors of {x.shape[1]} entries, fitted with {len(model.mean)}")
        y, k = model.project(x.astype(float)), len(model.eigenvalues)
        whitened = pa.ListArray.from_arrays(np.arange(0, k * len(x) + 1, k or 1)[: len(x) + 1] if k else np.zeros(len(x) + 1, np.int32), y.ravel())
        found = pa.StructArray.from_arrays([pa.array(deviations(model, x), pa.int64()), whitened], ["deviation", "whitened"])
        return found.take(pa.array(np.where(column.is_valid(), np.cumsum(column.is_valid()) - 1, 0), mask=~column.is_valid().to_numpy(zero_copy_only=False)))

    return df.withColumn(result_col, arrow_udf(each, "struct<deviation:bigint,whitened:array<double>>")(F.col(quote(x_col))))


def whitened_rows(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """A row for each vector of ``df`` and component: ``vec_id``, ``component`` (from 1), ``n``, ``deviation``,
    ``whitened``, ``explained``, ``identity_error``.

    Vectors that are null, empty or hold null or non-finite entries (or such beyond 2^62 units) have no
    rows. Null and repeated ids are kept, a row each. Without a component (an empty table, one distinct
    vector) there are no rows. Other columns of ``df``, whatever their names, are not looked at."""
    x = staged(df.select(F.col(quote(id_col)).alias("vec_id"), units(F.col(quote(vec_col))).alias("x")).where("x is not null"), "whitening-units")
    model = fit_whitening(x)
    if model is None or not len(model.eigenvalues):
        return x.select("vec_id", *[F.lit(None).cast(t).alias(c) for c, t in OUT]).limit(0)
    explained = F.array(*[F.lit(float(e / model.trace)) for e in model.eigenvalues])
    rows = whiten(x, model).select("vec_id", F.col("whitening.deviation").alias("deviation"), F.posexplode("whitening.whitened").alias("at", "whitened"))
    return rows.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(model.identity_error).alias("identity_error"),
    )


OUT = [("component", "int"), ("n", "long"), ("deviation", "long"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double")]
