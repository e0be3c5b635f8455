"""Whitening of embeddings by spectral divide and conquer.

Sums and second moments are exact integers, added up on the executors as one row per pair of dimensions. The driver
holds the covariance, whose size is the square of the dimension and does not grow with the rows. Its eigenvectors come
from polar decompositions: for a shift s the polar factor U of V - sI (QDWH: dynamically weighted Halley steps, by QR
while they are ill-conditioned, then by Cholesky) is the matrix sign, so (U + I) / 2 projects on the eigenvectors above
s. Bases of its range and of the complement split V into two smaller matrices, and so on down to single components.
The components go to the executors, which whiten every row.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigiframe.llm.vectors import finite, matrices

COMPONENTS = 32
SCALE, OFFSET = 64.0, 1_000_000
# Least magnitude of floor(64 c) that is refused: sums of a batch of rows stay longs below it.
MOST = float(1 << 45)
# Sums below this are kept as longs, others as Python's integers.
LONG = 2.0**62
EPS = float(np.finfo(float).eps)
# Eigenvalues below this share of the largest are rounding: their components are not whitened.
RANK_TOLERANCE = 1e-12
OUT = ("vec_id bigint, component int, n bigint, deviation bigint, deviation_exact decimal(38,0), whitened double, explained double, "
       "identity_error double")


# ---------------------------------------------------------------- spectral divide and conquer


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a square matrix by QDWH."""
    n = a.shape[0]
    size = np.sqrt(np.abs(a).sum(axis=0).max() * np.abs(a).sum(axis=1).max())
    if size == 0:
        return np.eye(n)
    x = a / size
    # A lower bound of the least singular value; below rounding it doesn't matter how far.
    least = float(np.linalg.norm(np.linalg.qr(x, mode="r").diagonal(), -np.inf)) / np.sqrt(n) if n > 1 else abs(float(x[0, 0]))
    low = min(1.0, max(least, EPS))
    for _ in range(30):
        d = np.cbrt(4 * (1 - low * low) / low**4)
        root = np.sqrt(1 + d)
        alpha = root + np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - low * low) / (low * low * root))) / 2
        beta = (alpha - 1) ** 2 / 4
        gamma = alpha + beta - 1
        if gamma > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(gamma) * x, np.eye(n)]))
            step = (alpha - beta / gamma) / np.sqrt(gamma) * (q[:n] @ q[n:].T)
        else:
            w = np.linalg.cholesky(np.eye(n) + gamma * (x.T @ x))
            step = (alpha - beta / gamma) * np.linalg.solve(w.T, np.linalg.solve(w, x.T)).T
        new = beta / gamma * x + step
        moved = np.linalg.norm(new - x)
        x = new
        low = min(1.0, low * (alpha + beta * low * low) / (1 + gamma * low * low))
        if abs(1 - low) < 10 * EPS and moved < EPS ** (1 / 3):
            break
    return x


def _basis(projector: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of the range of a projector of rank ``k`` and of its complement."""
    n = len(projector)
    order = np.argsort(-projector.diagonal(), kind="stable")
    q, _ = np.linalg.qr(projector[:, order[:k]])
    for _ in range(3):                              # subspace iteration: the chosen columns may be nearly dependent
        q, _ = np.linalg.qr(projector @ q)
    full, _ = np.linalg.qr(np.hstack([q, np.eye(n)]))
    full[:, :k] = q
    rest = full[:, k:n] - q @ (q.T @ full[:, k:n])
    rest, _ = np.linalg.qr(rest)
    return q, rest


def _pair(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and vectors of a symmetric matrix of order 2 by one rotation."""
    if v[0, 1] == 0:
        return v.diagonal().copy(), np.eye(2)
    tau = (v[1, 1] - v[0, 0]) / (2 * v[0, 1])
    t = (1.0 if tau >= 0 else -1.0) / (abs(tau) + np.hypot(1.0, tau))
    c = 1 / np.hypot(1.0, t)
    return np.array([v[0, 0] - t * v[0, 1], v[1, 1] + t * v[0, 1]]), np.array([[c, t * c], [-t * c, c]])


def _split(v: np.ndarray, size: float) -> tuple[np.ndarray, np.ndarray]:
    n = len(v)
    if n == 1:
        return v[0].copy(), np.eye(1)
    if n == 2:
        return _pair(v)
    middle = np.trace(v) / n
    if np.abs(v - middle * np.eye(n)).max() <= 4 * n * EPS * size:
        return v.diagonal().copy(), np.eye(n)      # one eigenvalue, any basis will do
    spread = np.linalg.norm(v - middle * np.eye(n)) / np.sqrt(n)
    best = None
    # The mean always has eigenvalues on both sides; others only serve where an eigenvalue lies on the shift.
    for shift in (float(np.median(v.diagonal())), middle, middle + 0.1 * spread, middle - 0.1 * spread, middle + 0.37 * spread, middle - 0.37 * spread):
        u = polar(v - shift * np.eye(n))
        projector = (u + u.T) / 4 + np.eye(n) / 2
        k = int(round(np.trace(projector)))
        if not 0 < k < n:
            continue
        q, rest = _basis(projector, k)
        left = np.linalg.norm(q.T @ v @ rest)
        if best is None or left < best[0]:
            best = (left, q, rest)
        if left <= 10 * n * EPS * size:
            break
    if best is None:
        raise ArithmeticError("no shift splits the covariance")
    values, vectors = [], []
    for basis in best[1:]:
        part = basis.T @ v @ basis
        e, w = _split((part + part.T) / 2, size)
        values.append(e)
        vectors.append(basis @ w)
    return np.concatenate(values), np.hstack(vectors)


def eigen(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix."""
    if not len(v):
        return np.empty(0), np.empty((0, 0))
    e, w = _split((v + v.T) / 2, float(np.linalg.norm(v)) or 1.0)
    # One step of refinement to first order: each pair of vectors is turned by its left-over product over its gap.
    inner = w.T @ v @ w
    values = inner.diagonal()
    gap = values[None, :] - values[:, None]
    close = np.abs(gap) <= 1e3 * EPS * np.abs(values).max()
    turn = np.where(close, 0.0, inner / np.where(close, 1.0, gap))
    np.fill_diagonal(turn, 0.0)
    w = w + w @ turn if np.abs(turn).max(initial=0.0) < 1e-6 else w
    w = 1.5 * w - 0.5 * w @ (w.T @ w)               # one step of orthogonalisation
    w = w / np.sqrt((w * w).sum(axis=0))
    e = ((v @ w) * w).sum(axis=0)
    order = np.argsort(-e, kind="stable")
    return e[order], w[:, order]


# ---------------------------------------------------------------- sums over all rows


def to_integers(vectors: np.ndarray) -> np.ndarray:
    """floor(64 c) + 1,000,000."""
    scaled = np.floor(SCALE * vectors)
    if len(scaled) and np.abs(scaled).max() >= MOST:
        raise ValueError("a component is too large: floor(64 c) has 45 bits or more")
    return scaled.astype(np.int64) + OFFSET


def _pairs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    i, j = np.triu_indices(len(values))
    return i, j, values[i, j]


def _sum_of_pairs(rows: DataFrame, dims: int, of_batch, kind: str = "decimal(38,0)") -> np.ndarray:
    """The symmetric matrix of sums over all rows of ``of_batch(matrix of a batch)``.

    Every task gives its sums as one row per pair of dimensions, which Spark adds up; the driver gets dims^2 / 2 numbers.
    """
    exact = kind != "double"

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, most = None, 0.0
        for batch in batches:
            for _, m in matrices(batch.column(0)):
                part = of_batch(m)
                most += float(np.abs(part).max(initial=0))
                if exact and most >= LONG:
                    part = part.astype(object)
                total = part if total is None else total + part
        if total is not None:
            i, j, v = _pairs(total)
            yield pa.record_batch([pa.array(i), pa.array(j), pa.array(v.tolist(), pa.decimal128(38, 0)) if exact else pa.array(v)], names=["i", "j", "v"])

    found = rows.select("vector").mapInArrow(partial, f"i bigint, j bigint, v {kind}").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    out = np.zeros((dims, dims), object if exact else float)
    for r in found:
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = int(r["v"]) if exact else r["v"]
    return out


class Moments:
    """Count, exact sums, and the covariance of the integer vectors."""

    def __init__(self, rows: DataFrame, dims: int, n: int):
        self.dims, self.n = dims, n
        # The sums of the values themselves, kept on a matrix's diagonal.
        first = _sum_of_pairs(rows, dims, lambda m: np.diag(to_integers(m).sum(axis=0)))
        self.sums = [int(first[d, d]) for d in range(dims)]
        self.centre = np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)   # nearest integers to the means
        centre = self.centre

        def products(m: np.ndarray) -> np.ndarray:
            z = to_integers(m) - centre
            most = float(np.abs(z).max(initial=0)) ** 2 * len(z)
            # Products of doubles are exact below 2^53, and far faster than those of longs.
            if most < 2.0**53:
                zf = z.astype(np.float64)
                return (zf.T @ zf).astype(np.int64)
            z = z if most < LONG else z.astype(object)
            return z.T @ z

        second = _sum_of_pairs(rows, dims, products)
        rest = [s - self.n * int(c) for s, c in zip(self.sums, centre)]
        # sum (x - mean)(y - mean) = sum zx zy - (sum zx)(sum zy) / n, in whole numbers until the one division.
        self.covariance = np.array([[float(Fraction(self.n * int(second[a, b]) - rest[a] * rest[b], self.n * self.n)) for b in range(dims)]
                                    for a in range(dims)]).reshape(dims, dims)
        self.shift = np.array([float(Fraction(r, self.n)) for r in rest])

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n in double precision."""
        return (x - self.centre).astype(np.float64) - self.shift

    def deviations(self, x: np.ndarray) -> list[int]:
        """Exact sums over dimensions of (n x - S)^2."""
        sums, n = np.array(self.sums, object), self.n
        reach = float(np.abs(self.centred(x)).max(initial=0)) * n
        if reach * reach * self.dims < LONG:
            off = n * (x - self.centre) - np.array([s - n * int(c) for s, c in zip(self.sums, self.centre)], np.int64)
            return (off * off).sum(axis=1).tolist()
        off = n * x.astype(object) - sums
        return (off * off).sum(axis=1).tolist()


def usual_length(df: DataFrame) -> tuple[int, int]:
    """The most frequent length of vector, the longer of equally frequent ones, and its rows; zeros where there is none."""
    found = df.groupBy(F.size("vector").alias("length")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), F.desc("length")).first()
    return (found["length"], found["rows"]) if found else (0, 0)


def whiten(df: DataFrame, id_column: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Whitened coordinates of every row: one row per component, up to ``components``.

    ``vec_id``, ``component`` from 1, ``n`` (rows fitted), ``deviation`` (sum over dimensions of (n x - S)^2, null where
    it does not fit a long; ``deviation_exact`` holds it as a decimal), ``whitened``, ``explained``, ``identity_error``
    (largest entry of the whitened coordinates' covariance minus the identity, measured over all rows). Rows whose
    vector is null or empty or holds null or non-finite entries are dropped, as are those of another length than the most
    frequent one (the longer of equally frequent ones). Components without variance (eigenvalues at most
    ``RANK_TOLERANCE`` of the largest) can't be whitened and are left out. Rows with a null or repeated id are kept, each
    for itself. An empty table, or one whose rows are all equal, gives no rows. Other columns are not looked at.
    """
    spark = df.sparkSession
    rows = df.select(F.col(f"`{id_column}`").cast("bigint").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    rows = rows.where(finite(F.col("vector")) & (F.size("vector") > 0))
    dims, n = usual_length(rows)
    if dims == 0:
        return spark.createDataFrame([], OUT)
    rows = rows.where(F.size("vector") == dims)
    moments = Moments(rows, dims, n)
    e, w = eigen(moments.covariance)
    kept = int(min(components, (e > RANK_TOLERANCE * e[0]).sum())) if e[0] > 0 else 0
    if kept == 0:
        return spark.createDataFrame([], OUT)
    scaled = w[:, :kept] / np.sqrt(e[:kept])
    trace = float(np.trace(moments.covariance))
    explained = e[:kept] / trace

    def covariance_part(m: np.ndarray) -> np.ndarray:
        y = moments.centred(to_integers(m)) @ scaled
        return y.T @ y

    # Means of the whitened coordinates are zero up to rounding, as the centred ones have exact means.
    measured = _sum_of_pairs(rows, kept, covariance_part, "double") / moments.n
    identity_error = float(np.abs(measured - np.eye(kept)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, m in matrices(batch.column(1)):
                x = to_integers(m)
                y = moments.centred(x) @ scaled
                deviation = moments.deviations(x)
                long = pa.array([d if d < 1 << 63 else None for d in deviation], pa.int64())
                exact = pa.array(deviation, pa.decimal128(38, 0))
                each = np.repeat(np.arange(len(m)), kept)
                yield pa.record_batch([
                    batch.column(0).take(pa.array(at[each])), pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), len(m))),
                    pa.array(np.full(len(each), moments.n)), long.take(pa.array(each)), exact.take(pa.array(each)), pa.array(y.ravel()),
                    pa.array(np.tile(explained, len(m))), pa.array(np.full(len(each), identity_error))],
                    names=["vec_id", "component", "n", "deviation", "deviation_exact", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, OUT)
