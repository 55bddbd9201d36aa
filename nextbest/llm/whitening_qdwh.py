"""Embedding whitening: QDWH spectral divide and conquer of the covariance.

1. Two aggregates over all vectors give the exact sums and the covariance:
   entries become whole numbers ``x = floor(64 * c) + 1000000``, products are
   taken of ``x`` less the whole part of its mean, summed as whole numbers in
   every task and merged exactly, and the rest of the mean comes off exactly
   too.  The result doesn't depend on how the rows are split.
2. The d x d covariance is split spectrally.  QDWH (dynamically weighted Halley
   steps) gives the orthogonal polar factor U of ``V - shift * I``; (U + I) / 2
   projects on the components with eigenvalues above the shift, (I - U) / 2 on
   the others.  Bases of the two subspaces split V into two smaller symmetric
   matrices, which are split in turn until single components are left.
3. The components are broadcast (at most ``components`` x d doubles), and every
   task whitens its own rows.  One more pass measures the covariance of what was
   whitened against the identity.

Only d sums and d * (d + 1) / 2 products a task leave the executors, summed per
pair before the driver gets them: what it holds depends on the dimension alone.

Edge cases: rows whose vector is null, or holds null, NaN or infinite entries,
are dropped; so is a vector whose length isn't the most frequent one (ties: the
longer), and empty ones, which have no component.  Repeated rows and ids count
each time, null ids are kept; a component without variance (fewer vectors than
dimensions, constant dimensions) has whitened 0, explained 0 and no part in
``identity_error``; an empty table gives an empty result.  ``deviation`` is null
where it exceeds a long.  Entries beyond 2^55 in size are refused with an error.
Only the id and vector columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nextbest.llm.common import slices

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
_EPS = np.finfo(float).eps
_EXACT = 1 << 53


# ------------------------------------------------- spectral divide and conquer

def qdwh(a: np.ndarray) -> np.ndarray | None:
    """Orthogonal polar factor of a symmetric matrix (None if it is numerically singular)."""
    n = len(a)
    top = np.abs(a).sum(axis=0).max()  # at least the largest singular value
    if not top:
        return None
    x, eye = a / top, np.eye(n)
    try:
        low = 1 / np.linalg.norm(np.linalg.inv(x), 1)
    except np.linalg.LinAlgError:
        return None
    if not low > 4 * _EPS:
        return None
    low = min(low / np.sqrt(n), 1.0)  # at most the smallest singular value
    for _ in range(40):
        square = low * low
        d = np.cbrt(4 * (1 - square) / (square * square))
        root = np.sqrt(1 + d)
        wa = root + np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - square) / (square * root))) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:  # inverse-free step
            q, _ = np.linalg.qr(np.concatenate([np.sqrt(wc) * x, eye]))
            new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        else:
            chol = np.linalg.cholesky(eye + wc * (x.T @ x))
            half = np.linalg.solve(chol, x.T)
            new = wb / wc * x + (wa - wb / wc) * np.linalg.solve(chol.T, half).T
        new = (new + new.T) / 2
        moved, x = np.linalg.norm(new - x), new
        low = min(1.0, low * (wa + wb * square) / (1 + wc * square))
        if moved <= 1e-5 and 1 - low <= 1e-8:  # the next step would move it by its cube
            break
    return x


def _halves(a: np.ndarray, shift: float) -> tuple[np.ndarray, int, float] | None:
    """(basis, components above ``shift`` (first), what couples the two parts)."""
    n = len(a)
    u = qdwh(a - shift * np.eye(n))
    if u is None:
        return None
    above = (u + np.eye(n)) / 2
    k = int(round(np.trace(above)))
    if not 0 < k < n:
        return None
    rng = np.random.default_rng(n)
    seeds = rng.standard_normal((n, n))
    basis = np.concatenate([above @ seeds[:, :k], seeds[:, k:] - above @ seeds[:, k:]], axis=1)
    for _ in range(2):  # the second round removes what the first basis lost to rounding
        first, _ = np.linalg.qr(basis[:, :k])
        rest, _ = np.linalg.qr(basis[:, k:])
        basis = np.concatenate([above @ first, rest - above @ rest], axis=1)
    basis, _ = np.linalg.qr(basis)
    return basis, k, float(np.linalg.norm(basis[:, k:].T @ a @ basis[:, :k]))


def spectral_split(a: np.ndarray) -> np.ndarray:
    """Orthonormal columns that diagonalise the symmetric matrix ``a``."""
    n = len(a)
    scale, middle = float(np.linalg.norm(a)), float(np.trace(a)) / max(n, 1)
    flat = a - middle * np.eye(n)
    spread = float(np.linalg.norm(flat))
    if n < 2 or spread <= 4 * _EPS * scale:
        return np.eye(n)
    # the mean eigenvalue always lies between two; the others serve where it hits one
    shifts = [float(np.median(np.diag(a))), middle,
              *(middle + f * spread / np.sqrt(n) for f in (0.1, -0.1, 0.3, -0.3, 0.01, -0.01))]
    best = None
    for shift in shifts:
        found = _halves(a, shift)
        if found is not None and (best is None or found[2] < best[2]):
            best = found
        if best is not None and best[2] <= 8 * n * _EPS * scale:
            break
    if best is None:  # no shift parts the spectrum: it is one point to working precision
        return np.eye(n)
    basis, k, _ = best
    inner = basis.T @ a @ basis
    inner = (inner + inner.T) / 2
    basis[:, :k] = basis[:, :k] @ spectral_split(inner[:k, :k])
    basis[:, k:] = basis[:, k:] @ spectral_split(inner[k:, k:])
    return basis


def principal_components(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as rows), each with its largest entry positive."""
    if not len(v):
        return np.zeros(0), np.zeros((0, 0))
    basis = spectral_split(v)
    # one step of iterative refinement: what is left beside the diagonal turns each pair
    for _ in range(2):
        inner = basis.T @ v @ basis
        values = np.diag(inner)
        gap = values[None, :] - values[:, None]
        turn = np.divide(inner, gap, out=np.zeros_like(inner), where=np.abs(gap) > 1e3 * np.abs(inner))
        np.fill_diagonal(turn, 0)
        basis, upper = np.linalg.qr(basis + basis @ ((turn - turn.T) / 2))
        basis = basis * np.sign(np.diag(upper))
    values = np.einsum("ij,ij->j", basis, v @ basis)
    order = np.argsort(-values, kind="stable")
    rows = basis[:, order].T
    lead = rows[np.arange(len(rows)), np.abs(rows).argmax(axis=1)]
    return values[order], rows * np.where(lead < 0, -1.0, 1.0)[:, None]


# ---------------------------------------------------------------- the passes

def _numbers(batch: pa.RecordBatch, dim: int, scale: int, offset: int) -> np.ndarray:
    """The whole numbers of a batch of clean vectors, one row each."""
    flat = batch.column(batch.schema.get_field_index("v")).flatten().to_numpy(zero_copy_only=False)
    scaled = np.floor(scale * flat.astype(np.float64))
    if len(scaled) and np.abs(scaled).max() >= 2.0 ** 61:
        raise ValueError("an entry is too large for whole numbers of 64 bits")
    return (scaled.astype(np.int64) + offset).reshape(-1, dim)


def _products(y: np.ndarray) -> np.ndarray:
    """y.T @ y in whole numbers (Python's where 64 bits could overflow)."""
    most = int(np.abs(y).max(initial=0))
    if most * most * max(len(y), 1) < _EXACT:
        real = y.astype(np.float64)  # sums below 2^53 are exact, and far faster
        return (real.T @ real).astype(np.int64).astype(object)
    return y.astype(object).T @ y.astype(object)


def clean_vectors(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(id, v)`` of the rows whose vector is whole and finite; entries as doubles."""
    v = F.transform(F.col(vector), lambda c: c.cast("double"))
    good = F.col(vector).isNotNull() & F.forall(
        F.col(vector), lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))
        & (F.abs(c.cast("double")) < float("inf")))
    return rows.where(good).select(F.col(vec_id).alias("id"), v.alias("v"))


class Fit:
    """Exact sums, the covariance and the components of a fit list."""

    def __init__(self, n: int, sums: list[int], products: dict[tuple[int, int], int],
                 base: list[int], components: int) -> None:
        d = len(sums)
        self.n, self.sums, self.dim = n, sums, d
        rest = [s - n * b for s, b in zip(sums, base)]  # sums of x - base
        v = np.zeros((d, d))
        for (i, j), p in products.items():
            v[i, j] = v[j, i] = (n * p - rest[i] * rest[j]) / (n * n)
        self.covariance = v
        values, self.rows = principal_components(v)
        self.rows = self.rows[:components]
        trace = float(np.trace(v))
        kept = values[:components]
        varied = kept > d * 16 * _EPS * max(float(values[0]) if d else 0.0, 0.0)
        self.varied = varied & (kept > 0)
        self.values = np.where(self.varied, kept, 0.0)
        self.explained = self.values / trace if trace > 0 else self.values
        # whole and broken part of the mean: x - base is exact, and small
        self.base = np.array(base, dtype=np.int64)
        self.rest = np.array([r / n for r in rest])
        self.weights = np.zeros_like(self.rows)
        self.weights[self.varied] = self.rows[self.varied] / np.sqrt(
            self.values[self.varied])[:, None]

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.base) - self.rest) @ self.weights.T

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - S)^2, exact."""
        gap = x - self.base
        rest = [s - self.n * int(b) for s, b in zip(self.sums, self.base)]
        most = self.n * (int(np.abs(gap).max(initial=0)) + 1)
        if most * most * max(self.dim, 1) < 1 << 63:
            away = self.n * gap - np.array(rest, dtype=np.int64)
            return (away * away).sum(axis=1).tolist()
        away = self.n * gap.astype(object) - np.array(rest, dtype=object)
        return [int(s) if s < 1 << 63 else None for s in (away * away).sum(axis=1)]


def _sums(vectors: DataFrame, dim: int, scale: int, offset: int) -> tuple[int, list[int]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dim
        for batch in slices(batches, "v"):
            x = _numbers(batch, dim, scale, 0)
            n += len(x)
            wide = np.abs(x).max(initial=0) >= 1 << 40
            part = (x.astype(object) if wide else x).sum(axis=0).tolist()
            total = [a + int(b) for a, b in zip(total, part)]
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(-1, dim), pa.int32()),
                 pa.array([n, *(t + n * offset for t in total)], pa.decimal128(38, 0))], names=["i", "s"])

    rows = dict(map(tuple, vectors.mapInArrow(run, "i int, s decimal(38,0)").groupBy("i")
                    .agg(F.sum("s").alias("s")).collect()))
    return int(rows.get(-1, 0)), [int(rows[i]) for i in range(dim)] if rows else []


def _product_sums(vectors: DataFrame, dim: int, scale: int, offset: int,
                  base: list[int]) -> dict[tuple[int, int], int]:
    whole = np.array(base, dtype=np.int64)
    upper_i, upper_j = np.triu_indices(dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in slices(batches, "v"):
            part = _products(_numbers(batch, dim, scale, offset) - whole)
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(upper_i, pa.int32()), pa.array(upper_j, pa.int32()),
                 pa.array(total[upper_i, upper_j].tolist(), pa.decimal128(38, 0))],
                names=["i", "j", "p"])

    rows = vectors.mapInArrow(run, "i int, j int, p decimal(38,0)").groupBy("i", "j").agg(
        F.sum("p").alias("p")).collect()
    return {(r["i"], r["j"]): int(r["p"]) for r in rows}


def _identity_error(vectors: DataFrame, shared, scale: int, offset: int) -> float:
    """Largest entry of the covariance of the whitened vectors, less the identity."""
    fit = shared.value
    k = len(fit.rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit, total = shared.value, np.zeros((k, k))
        for batch in slices(batches, "v"):
            w = fit.whiten(_numbers(batch, fit.dim, scale, offset))
            total += w.T @ w  # whiten has taken the mean off
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(k), k), pa.int32()),
             pa.array(np.tile(np.arange(k), k), pa.int32()), pa.array(total.reshape(-1))],
            names=["i", "j", "p"])

    rows = vectors.mapInArrow(run, "i int, j int, p double").groupBy("i", "j").agg(
        F.sum("p").alias("p")).collect()
    on = fit.varied
    return max((abs(r["p"] / fit.n - (r["i"] == r["j"])) for r in rows
                if on[r["i"]] and on[r["j"]]), default=0.0)


def fit_whitening(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE,
                  offset: int = OFFSET) -> tuple[Fit | None, DataFrame]:
    """The fit of ``clean_vectors`` rows, and those of the fit's dimension (None: there are none)."""
    sizes = vectors.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    first = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    if first is None or not first["d"]:
        return None, vectors.limit(0)
    dim = first["d"]
    same = vectors.where(F.size("v") == dim)
    n, sums = _sums(same, dim, scale, offset)
    base = [s // n for s in sums]
    return Fit(n, sums, _product_sums(same, dim, scale, offset, base), base, components), same


def whitened(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
             components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """One row per vector and component: ``vec_id``, component, n, deviation, whitened,
    explained, identity_error."""
    vectors = clean_vectors(rows, vec_id, vector)
    kind = vectors.schema["id"].dataType.simpleString()
    schema = (f"`{vec_id}` {kind}, component int, n long, deviation long, whitened double, "
              "explained double, identity_error double")
    spark = rows.sparkSession
    fit, same = fit_whitening(vectors, components, scale, offset)
    if fit is None:
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast(fit)
    error = _identity_error(same, shared, scale, offset)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit = shared.value
        k = len(fit.rows)
        for batch in slices(batches, "v", 1 << 20):
            x = _numbers(batch, fit.dim, scale, offset)
            m = len(x)
            ids = batch.column(batch.schema.get_field_index("id")).take(
                pa.array(np.repeat(np.arange(m), k)))
            away = pa.array(fit.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(m), k)))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                 pa.array(np.full(m * k, fit.n, dtype=np.int64)), away,
                 pa.array(fit.whiten(x).reshape(-1)), pa.array(np.tile(fit.explained, m)),
                 pa.array(np.full(m * k, error))],
                names=[vec_id, "component", "n", "deviation", "whitened", "explained",
                       "identity_error"])

    return same.mapInArrow(run, schema)
