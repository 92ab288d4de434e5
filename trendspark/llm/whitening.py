"""Whitening of embedding vectors by spectral divide and conquer.

The covariance of all vectors is summed in tasks. The driver splits it, a matrix of dimension by dimension whatever the
number of vectors: the polar factor of the shifted covariance (QDWH iteration: QR and Cholesky steps with dynamic
weights) gives the spectral projectors on both sides of the shift, each invariant subspace is split again until it is
one-dimensional, and the leading components go to all tasks to whiten every vector.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.llm.arrow import batch, columns, map_batches, stored

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
_EPS = np.finfo(float).eps
_LONG = (1 << 63) - 1


# --- the symmetric eigenproblem ------------------------------------------------------------


def polar_factor(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix by the QDWH iteration."""
    n = len(a)
    norm = np.linalg.norm(a)
    if not norm:
        return np.eye(n)
    x = a / norm
    # A lower bound of the smallest singular value; too small a bound costs a step, no accuracy.
    try:
        low = 0.9 / np.linalg.norm(np.linalg.inv(x))
    except np.linalg.LinAlgError:
        low = 0.0
    low = min(max(low, _EPS), 0.9) if math.isfinite(low) else _EPS
    for _ in range(40):
        l2 = low * low
        d = (4 * (1 - l2) / (l2 * l2)) ** (1 / 3)
        root = math.sqrt(1 + d)
        wa = root + math.sqrt(max(8 - 4 * d + 8 * (2 - l2) / (l2 * root), 0)) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            q, _ = np.linalg.qr(np.vstack([math.sqrt(wc) * x, np.eye(n)]))
            after = wb / wc * x + (wa - wb / wc) / math.sqrt(wc) * (q[:n] @ q[n:].T)
        else:
            lower = np.linalg.cholesky(np.eye(n) + wc * (x.T @ x))
            half = np.linalg.solve(lower, x.T)
            after = wb / wc * x + (wa - wb / wc) * np.linalg.solve(lower.T, half).T
        low = min(low * (wa + wb * l2) / (1 + wc * l2), 1.0)
        moved = np.linalg.norm(after - x)
        x = (after + after.T) / 2
        if moved <= (4 * _EPS) ** (1 / 3) and 1 - low < 10 * _EPS:
            break
    return x


def _basis(projector: np.ndarray, rank: int) -> np.ndarray:
    """Orthonormal columns: the first ``rank`` span the range of a projector, the others its complement."""
    start = projector[:, np.argsort(-np.diag(projector), kind="stable")[:rank]]
    q, _ = np.linalg.qr(start)
    for _ in range(2):
        q, _ = np.linalg.qr(projector @ q)
    rest, _ = np.linalg.qr(np.hstack([q, np.eye(len(projector)) - q @ q.T]))
    return rest[:, : len(projector)]


def spectral_split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of a symmetric matrix.

    A matrix that is a multiple of the identity to working precision gives the unit vectors.
    """
    a = (a + a.T) / 2
    n = len(a)
    whole = np.linalg.norm(a)

    def split(part: np.ndarray) -> tuple[list[float], np.ndarray]:
        m = len(part)
        diagonal = np.diag(part)
        if m == 1 or np.linalg.norm(part - np.diag(diagonal)) <= _EPS * whole:
            return list(diagonal), np.eye(m)
        centre = diagonal.mean()
        spread = np.linalg.norm(part - centre * np.eye(m)) / math.sqrt(m)
        # Eigenvalues lie on both sides of their mean; beside a value in between, the shift moves a little.
        for nudge in (0.0, 0.25, -0.25, 0.5, -0.5, 0.1, -0.1, 0.75, -0.75):
            u = polar_factor(part - (centre + nudge * spread) * np.eye(m))
            projector = (u + np.eye(m)) / 2
            rank = round(float(np.trace(projector)))
            if not 0 < rank < m or np.linalg.norm(projector @ projector - projector) > 1e-8:
                continue
            q = _basis(projector, rank)
            turned = q.T @ part @ q
            turned = (turned + turned.T) / 2
            if np.linalg.norm(turned[:rank, rank:]) <= 1e4 * _EPS * max(np.linalg.norm(part), _EPS * whole):
                break
        else:  # no gap at any shift: the values are equal to working precision
            return list(diagonal), np.eye(m)
        high, high_vectors = split(turned[:rank, :rank])
        low, low_vectors = split(turned[rank:, rank:])
        return high + low, np.hstack([q[:, :rank] @ high_vectors, q[:, rank:] @ low_vectors])

    _, vectors = split(a)
    vectors, _ = np.linalg.qr(vectors)
    values = np.einsum("ij,ik,kj->j", vectors, a, vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


# --- sums over all vectors -------------------------------------------------------------------


def _matrix(column: pa.Array, dtype) -> np.ndarray:
    rows = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(rows, len(flat) // rows if rows else 0).astype(dtype, copy=False)


def _summed(table: DataFrame, column: str, kind: str, of: Callable[[np.ndarray], np.ndarray]) -> dict[int, float | int]:
    """Sums over all rows of what ``of`` makes of a block of vectors: one number a place, from each task one row a place."""
    schema = pa.schema([("place", pa.int64()), ("value", pa.int64() if kind == "bigint" else pa.float64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for rows in batches:
            if rows.num_rows:
                part = of(rows.column(0))
                total = part if total is None else total + part
        if total is not None:
            yield batch(schema, np.arange(len(total)), total)

    parts = map_batches(table.select(column), task, f"place bigint, value {kind}")
    # Sums of longs may pass 64 bits.
    value = F.col("value").cast("decimal(38,0)") if kind == "bigint" else F.col("value")
    return {r[0]: r[1] for r in parts.groupBy("place").agg(F.sum(value)).collect()}


def _covariance(table: DataFrame, column: str, mean: np.ndarray, n: int) -> np.ndarray:
    """Covariance (divisor n) of the vectors of a column of double or long lists; centred before multiplying."""
    d = len(mean)
    upper = np.triu_indices(d)

    def products(vectors: pa.Array) -> np.ndarray:
        centred = _matrix(vectors, float) - mean
        return (centred.T @ centred)[upper]

    found = _summed(table, column, "double", products)
    out = np.zeros((d, d))
    out[upper] = [found[i] for i in range(len(upper[0]))]
    return (out + np.triu(out, 1).T) / n


@dataclass(frozen=True)
class Whitener:
    """A fitted transform: counts, sums, and the leading components."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def usable_vectors(df: DataFrame, vector_col: str = "embedding", id_col: str = "vec_id", scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """(id, x) with x = floor(scale * c) + shift of rows whose vector has finite entries only."""
    entry = F.col("v").cast("array<double>")
    bad = F.exists(entry, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = columns(df, id=id_col, v=vector_col).filter(F.col("v").isNotNull() & (F.size("v") > 0) & ~bad)
    return rows.select("id", F.transform(entry, lambda c: F.floor(c * scale) + F.lit(shift).cast("bigint")).alias("x"))


def fit_whitener(vectors: DataFrame, components: int = COMPONENTS) -> Whitener | None:
    """Fit on a stored table (id, x) of equally long vectors; None for an empty one."""
    first = vectors.agg(F.count("*"), F.max(F.size("x"))).first()
    n, d = first[0], first[1]
    if not n:
        return None
    found = _summed(vectors, "x", "bigint", lambda v: _matrix(v, np.int64).sum(axis=0))
    sums = tuple(int(found[i]) for i in range(d))
    mean = np.array([s / n for s in sums])
    v = _covariance(vectors, "x", mean, n)
    values, axes = spectral_split(v)
    # A component without variance cannot be scaled to one.
    kept = int(np.count_nonzero(values > d * _EPS * max(values[0], 0)))
    kept = min(kept, components)
    return Whitener(n, sums, values[:kept], axes[:, :kept], float(np.trace(v)))


def _deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Exact sums of (n * x - S) ** 2; null where 64 bits do not hold one."""
    most = max(abs(int(x.min())), abs(int(x.max()))) * n + max(map(abs, sums)) if x.size else 0
    if most * most * len(sums) <= _LONG:
        gap = n * x - np.array(sums, np.int64)
        return np.einsum("ij,ij->i", gap, gap).tolist()
    gap = x.astype(object) * n - np.array(sums, object)
    return [total if total <= _LONG else None for total in map(int, (gap * gap).sum(axis=1))]


def whiten(vectors: DataFrame, fitted: Whitener) -> DataFrame:
    """(id, deviation, w): whitened coordinates of each row, components in falling order."""
    mean, sums, n = fitted.mean, fitted.sums, fitted.n
    turn = fitted.vectors / np.sqrt(fitted.values)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            if not rows.num_rows:
                continue
            x = _matrix(rows.column("x"), np.int64)
            w = (x - mean) @ turn
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * w.shape[1], pa.int32())
            lists = pa.ListArray.from_arrays(ends, pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays([rows.column("id"), pa.array(_deviations(x, n, sums), pa.int64()), lists], ["id", "deviation", "w"])

    id_type = vectors.schema["id"].dataType.simpleString()
    return map_batches(vectors, task, f"id {id_type}, deviation bigint, w array<double>")


def whitened_embeddings(df: DataFrame, vector_col: str = "embedding", id_col: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """One row for each usable vector and component: (vec_id, component, n, deviation, whitened, explained, identity_error).

    Rows whose vector is null or empty or holds null, NaN or infinite entries are left out, and so are vectors of another
    length than the commonest (the longest of equally common ones). Rows are kept as they come: repeated rows count as
    often as they are there, null ids stay null, other columns are not read. Components without variance (all vectors
    equal along them) are not returned, so a table of one vector, or of none, has no rows. ``deviation`` is null where 64
    bits do not hold it. Entries must keep ``1024 * c`` within 62 bits. Ties between eigenvalues give some orthonormal
    basis of their space.

    The driver holds matrices of dimension by dimension; rows stay in tasks.
    """
    usable = stored(usable_vectors(df, vector_col, id_col), "vectors")
    size = F.size("x")
    common = usable.groupBy(size.alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    schema = f"vec_id {usable.schema['id'].dataType.simpleString()}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if common is None:
        return df.sparkSession.createDataFrame([], schema)
    vectors = usable.filter(size == common["d"])
    fitted = fit_whitener(vectors, components)
    k = len(fitted.values)
    if not k:
        return df.sparkSession.createDataFrame([], schema)
    done = stored(whiten(vectors, fitted), "whitened")
    sums = _summed(done, "w", "double", lambda v: _matrix(v, float).sum(axis=0))
    mean = np.array([sums[i] / fitted.n for i in range(k)])
    error = float(np.abs(_covariance(done, "w", mean, fitted.n) - np.eye(k)).max())
    explained = F.array(*[F.lit(float(e / fitted.trace)) for e in fitted.values])
    each = done.select("id", "deviation", F.posexplode("w").alias("place", "whitened"))
    return each.select(
        F.col("id").alias("vec_id"),
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(fitted.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.element_at(explained, F.col("place") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
