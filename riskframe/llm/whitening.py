"""Whitening of embeddings by their principal components.

Vectors are made whole numbers, x = floor(64 c) + 1000000 per entry, and the components are fitted on the distinct vectors. Sums
are exact; the covariance is added up from centred products, one small matrix per task. Its leading
eigenvectors come from a Householder tridiagonalisation, bisection with Sturm counts for the eigenvalues, and
inverse iteration on the tridiagonal matrix, where vectors of close eigenvalues are made orthogonal again. Every vector is then projected
in a map pass; the components are a broadcast of dimension x components numbers.

Only matrices of dimension x dimension numbers reach the driver, whatever the number of vectors. Equal vectors are
brought together by partial aggregation, so a vector that fills a third of the table is one row per task.

Rows take no part if the vector is null, or holds null or non-finite entries (or ones of 2^40 or more, past the exact sums), or has
another length than most (ties: the longer). Repeated rows, and rows with a null id, each get their result. Components without
variance (eigenvalue not above dimension x 2^-52 of the largest) are not given; so one distinct vector, or none, gives no rows.
``deviation`` is null where a long can't hold it. Other columns are not read.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage_table

COMPONENTS = 16
#: The contract's fixed grid: x = floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
_MOST = float(1 << 40)
_EPS = 2.0 ** -52


def whole_vectors(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(vec_id, x) of the rows that take part."""
    e = F.col(column)
    sound = e.isNotNull() & (F.size(e) > 0) & F.forall(e, lambda c: F.coalesce(F.abs(c.cast("double")) < _MOST, F.lit(False)))
    some = vectors.select(F.col(id_column).cast("long").alias("vec_id"), e.alias("e")).where(sound)
    most = (some.groupBy(F.size("e").alias("d")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), F.desc("d")).limit(1)).collect()
    d = most[0]["d"] if most else 0
    return some.where(F.size("e") == d).select(
        "vec_id", F.transform("e", lambda c: F.floor(c.cast("double") * SCALE) + SHIFT).alias("x"))


def _matrix(batch: pa.RecordBatch, column: str) -> np.ndarray:
    """The rows of a list column as a matrix."""
    values = batch.column(column)
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


@dataclass(frozen=True)
class Centre:
    """The exact mean of whole vectors: S = n * whole + rest, 0 <= rest < n per dimension."""

    n: int
    whole: np.ndarray
    rest: np.ndarray

    def minus(self, x: np.ndarray) -> np.ndarray:
        """x - S / n: the whole part exactly, the rest rounded once."""
        return (x - self.whole).astype(float) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> pa.Array:
        """The sum over dimensions of (n x - S)^2, null where a long can't hold it."""
        gap = x - self.whole
        fits = ((self.n * np.abs(gap.astype(float)) + self.n) ** 2).sum(axis=1) < 9e18
        gap = np.where(fits[:, None], gap, 0)
        return pa.array(((self.n * gap - self.rest) ** 2).sum(axis=1), mask=~fits)


def centre_of(fit: DataFrame) -> Centre:
    """Number and mean of the whole vectors ``fit`` (x), added up exactly: a row per dimension and batch, then per dimension."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            if batch.num_rows:
                sums = _matrix(batch, "x").sum(axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums))), pa.array(np.full(len(sums), batch.num_rows)), pa.array(sums)],
                                                 names=["i", "n", "s"])

    rows = fit.mapInArrow(run, "i long, n long, s long").groupBy("i").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(20,0)")).alias("s")).orderBy("i").collect()
    n = rows[0]["n"] if rows else 0
    parts = [divmod(int(r["s"]), n) for r in rows]
    return Centre(n, np.array([p[0] for p in parts], np.int64), np.array([p[1] for p in parts], np.int64))


def _covariance(fit: DataFrame, centred, n: int, d: int) -> np.ndarray:
    """The covariance (divisor ``n``) of ``centred(x)`` over ``fit``: one matrix of sums of products per task, added up by row.

    ``centred`` gives rows of ``d`` numbers with mean 0.
    """
    def run(batches: Iterator[pa.RecordBatch]):
        total = np.zeros((d, d))
        for batch in batches:
            if batch.num_rows:
                y = centred(_matrix(batch, "x"))
                total += y.T @ y
        i, j = np.triu_indices(d)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], names=["i", "j", "s"])

    out = np.zeros((d, d))
    for r in fit.mapInArrow(run, "i long, j long, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["s"] / n
    return out


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, off-diagonal, reflectors) of a symmetric matrix by Householder reflections."""
    a = np.array(v, float)
    d = len(a)
    reflectors = []
    for k in range(d - 2):
        u = a[k + 1:, k].copy()
        size = np.linalg.norm(u)
        if size:
            u[0] += math.copysign(size, u[0])
            u /= np.linalg.norm(u)
            # A - 2 u w' - 2 w u', with w = A u - (u' A u) u
            w = a[k + 1:, k + 1:] @ u
            w -= (u @ w) * u
            a[k + 1:, k + 1:] -= 2 * (np.outer(u, w) + np.outer(w, u))
            a[k + 1, k] = a[k, k + 1] = -math.copysign(size, a[k + 1, k])
        reflectors.append(u)
    return np.diag(a).copy(), np.array([a[k + 1, k] for k in range(d - 1)]), reflectors


def sturm_count(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each number in ``at``, how many eigenvalues of the tridiagonal matrix lie below it (the signs of the pivots of T - at)."""
    least = np.finfo(float).tiny * max(1.0, float((off ** 2).max(initial=0.0)))
    q = diagonal[0] - at
    count = (q < 0).astype(int)
    for a, b in zip(diagonal[1:], off):
        q = np.where(np.abs(q) < least, -least, q)
        q = a - at - b * b / q
        count += q < 0
    return count


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, each halved down to neighbouring doubles."""
    d = len(diagonal)
    reach = np.concatenate([[0.0], np.abs(off)]) + np.concatenate([np.abs(off), [0.0]])
    low, high = np.full(k, (diagonal - reach).min()), np.full(k, (diagonal + reach).max())
    low, high = low - _EPS * np.abs(low) * d - 1e-300, high + _EPS * np.abs(high) * d + 1e-300
    rank = d - 1 - np.arange(k)                     # so many eigenvalues lie below it
    for _ in range(1100):
        mid = low + (high - low) / 2
        if ((mid <= low) | (mid >= high)).all():
            break
        below = sturm_count(diagonal, off, mid) > rank
        low, high = np.where(below, low, mid), np.where(below, mid, high)
    return low + (high - low) / 2


def _solver(diagonal: np.ndarray, off: np.ndarray, e: float, least: float):
    """A function that solves (T - e) z = r: elimination with row exchanges, done once; small pivots become ``least``."""
    d = len(diagonal)
    steps, upper = [], []
    p, q, r = diagonal[0] - e, off[0] if d > 1 else 0.0, 0.0
    for i in range(d - 1):
        a, b, c = off[i], diagonal[i + 1] - e, off[i + 1] if i + 2 < d else 0.0
        swap = abs(a) > abs(p)
        if swap:
            p, q, r, a, b, c = a, b, c, p, q, r
        if abs(p) < least:
            p = least
        f = a / p
        steps.append((swap, f))
        upper.append((p, q, r))
        p, q, r = b - f * q, c - f * r, 0.0
    upper.append((p if abs(p) >= least else least, 0.0, 0.0))

    def solve(right: np.ndarray) -> np.ndarray:
        z = right.tolist()
        for i, (swap, f) in enumerate(steps):
            if swap:
                z[i], z[i + 1] = z[i + 1], z[i]
            z[i + 1] -= f * z[i]
        z += [0.0, 0.0]
        for i in range(d - 1, -1, -1):
            p, q, r = upper[i]
            z[i] = (z[i] - q * z[i + 1] - r * z[i + 2]) / p
        return np.array(z[:d])

    return solve


def leading_eigenvectors(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as rows) of the ``k`` largest eigenvalues of a symmetric matrix, falling."""
    d = len(v)
    k = min(k, d)
    diagonal, off, reflectors = tridiagonal(v)
    values = leading_eigenvalues(diagonal, off, k)
    norm = float(max(np.abs(diagonal).max(initial=0.0), np.abs(off).max(initial=0.0)))
    if not norm:
        return np.zeros(k), np.eye(d)[:k]
    rng = np.random.default_rng(1)
    vectors = np.zeros((k, d))
    cluster, shifted = 0, 0.0                       # where the cluster of close eigenvalues starts
    for j in range(k):
        e = values[j]
        if j and values[j - 1] - values[j] > 1e-3 * norm:
            cluster = j
        if j > cluster:                             # equal eigenvalues are solved for a little apart
            e = min(e, shifted - 10 * _EPS * norm)
        shifted = e
        solve = _solver(diagonal, off, e, _EPS * norm)
        z = rng.standard_normal(d)
        for _ in range(5):
            z = solve(z / np.linalg.norm(z))
            for _ in range(2):
                for other in vectors[cluster:j]:
                    z -= (other @ z) * other
        vectors[j] = z / np.linalg.norm(z)
    for i in range(len(reflectors) - 1, -1, -1):    # back through the reflections
        u = reflectors[i]
        vectors[:, i + 1:] -= 2 * np.outer(vectors[:, i + 1:] @ u, u)
    return values, vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


@dataclass(frozen=True)
class Whitening:
    """The fitted components: ``values`` (eigenvalues), ``vectors`` (rows), ``explained`` shares of the variance, and the
    largest entry of the whitened fit list's covariance minus the identity."""

    centre: Centre
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows of whole vectors."""
        return self.centre.minus(x) @ self.vectors.T / np.sqrt(self.values)


def fit_whitening(vectors: DataFrame, components: int = COMPONENTS) -> Whitening:
    """The whitening of the distinct vectors in ``vectors`` (x)."""
    fit = stage_table(vectors.select("x").distinct(), "whitening-fit")
    centre = centre_of(fit)
    d = len(centre.whole)
    if not d:
        return Whitening(centre, np.zeros(0), np.zeros((0, 0)), np.zeros(0), 0.0)
    v = _covariance(fit, centre.minus, centre.n, d)
    values, rows = leading_eigenvectors(v, components)
    has = values > d * _EPS * max(values[0], 0.0)
    trace = float(np.trace(v))
    made = Whitening(centre, values[has], rows[has], values[has] / trace if trace else values[has], 0.0)
    k = len(made.values)
    # the mean of the whitened vectors is 0 but for rounding, as that of the centred ones is
    error = float(np.abs(_covariance(fit, made.project, centre.n, k) - np.eye(k)).max()) if k else 0.0
    return Whitening(centre, made.values, made.vectors, made.explained, error)


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id",
           column: str = "embedding") -> tuple[DataFrame, Whitening]:
    """((vec_id, deviation, whitened) of every row that takes part, ``whitened`` an array by component; the fitted components)."""
    rows = whole_vectors(vectors, id_column, column)
    made = fit_whitening(rows, components)
    shared = vectors.sparkSession.sparkContext.broadcast(made)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            if batch.num_rows and len(shared.value.values):
                x = _matrix(batch, "x")
                w = shared.value.project(x)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), shared.value.centre.deviations(x),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1]), pa.array(w.ravel()))],
                    names=["vec_id", "deviation", "whitened"])

    return rows.mapInArrow(run, "vec_id long, deviation long, whitened array<double>"), made


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the 16 leading whitened components."""
    out, made = whiten(spark.read.parquet(os.path.join(sf_dir, "embeddings.parquet")).select("vec_id", "embedding"))
    share = F.array(*[F.lit(float(s)) for s in made.explained]) if len(made.explained) else F.array(F.lit(None).cast("double"))
    return out.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(made.centre.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("at")).alias("explained"), F.lit(made.identity_error).alias("identity_error"))
