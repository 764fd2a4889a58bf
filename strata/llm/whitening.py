"""Whitening of embeddings by eigenvectors refined in mixed precision.

Entries are put on an integer grid, so sums and the covariance over the
distinct vectors are exact integers, added up in any order by the cluster. The
driver sees one matrix of the vectors' dimension: its eigenvectors are found in
float32 and corrected by Ogita and Aishima's iterations (matrix products in
extended precision); eigenvalues too close for a step to tell apart are solved
among themselves, in their own subspace, and the iterations go on.

Defined cases: rows whose vector is null or holds null or non-finite entries,
or is of another length than the most frequent one (the longer of equally
frequent), are dropped; a null id is kept; repeated rows are rows of the result
each, and one vector of the fit; components without variance (eigenvalue below
rounding) are left out, so a single distinct vector, or an empty table, gives
no rows; columns other than the id and the vector are not read. Exact values
beyond 64 bits raise.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.sinks.writer import stage

GRID, SHIFT = 64, 1_000_000
COMPONENTS = 16
_EXACT = 1 << 53
_LOW = 40
ROWS_PER_PRODUCT = 4_096


# ------------------------------------------------------------- eigenvectors
def eigenvectors(v: np.ndarray, iterations: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors of the symmetric ``v`` (extended precision), correct to double precision."""
    a = v.astype(np.longdouble)
    scale = np.abs(a).max(initial=0)
    if not len(a) or scale == 0:
        return np.zeros(len(a), np.longdouble), np.eye(len(a), dtype=np.longdouble)
    a = a / scale
    x = np.linalg.eigh(a.astype(np.float32))[1][:, ::-1].astype(np.longdouble)
    for _ in range(iterations):
        x, step, groups = _refine(a, x)
        if groups:
            x = _separate(a, x, groups)
        elif step < 2.0**-58:
            break
    for _ in range(2):  # what rounding has left between vectors of equal eigenvalues
        x = _orthonormal(x)
    value = ((a @ x) * x).sum(0) / (x * x).sum(0)
    order = np.argsort(-value, kind="stable")
    x = x[:, order]
    return value[order] * scale, x / np.sqrt((x * x).sum(0))


def _refine(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, float, list[np.ndarray]]:
    """One iteration: the corrected vectors, the size of the correction, and the sets of vectors it could not tell apart."""
    n = len(a)
    r = np.eye(n, dtype=np.longdouble) - x.T @ x
    s = x.T @ (a @ x)
    value = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(np.diag(s))
    bound = 2 * (np.abs(off).sum(1).max() + np.abs(value).max() * np.abs(r).sum(1).max())
    gap = value[None, :] - value[:, None]
    apart = np.abs(gap) > max(bound, 2.0**-50 * np.abs(value).max())
    with np.errstate(divide="ignore", invalid="ignore"):
        e = np.where(apart, (s + value[None, :] * r) / gap, r / 2)
    # close values whose vectors already agree with the matrix need no solving among themselves
    mixed = ~apart & (np.abs(off + value[None, :] * (r - np.diag(np.diag(r)))) > 2.0**-54 * np.abs(value).max())
    return x + x @ e, float(np.abs(e).max()), _groups(value, ~apart) if mixed.any() else []


def _orthonormal(x: np.ndarray) -> np.ndarray:
    """A Newton step towards the nearest orthonormal columns."""
    return x @ (1.5 * np.eye(x.shape[1], dtype=np.longdouble) - 0.5 * (x.T @ x))


def _groups(value: np.ndarray, close: np.ndarray) -> list[np.ndarray]:
    """Runs of neighbouring eigenvalues linked by ``close``."""
    order = np.argsort(-value, kind="stable")
    cut = np.flatnonzero(~close[order[:-1], order[1:]]) + 1
    return [g for g in np.split(order, cut) if len(g) > 1]


def _separate(a: np.ndarray, x: np.ndarray, groups: list[np.ndarray]) -> np.ndarray:
    """Rotates each group within its own subspace: its part of the matrix, centred and scaled, is solved alone."""
    x = x.copy()
    for g in groups:
        y = _orthonormal(x[:, g])
        b = y.T @ (a @ y)
        b = b - np.eye(len(g), dtype=np.longdouble) * np.trace(b) / len(g)
        size = np.abs(b).max()
        if size > 0:
            w = np.linalg.eigh(((b + b.T) / (2 * size)).astype(np.float64))[1][:, ::-1].astype(np.longdouble)
            y = y @ _orthonormal(w)
        x[:, g] = y
    return x


# --------------------------------------------------------------- statistics
def grid(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, x): the rows that take part, on the integer grid."""
    v = F.col(vector).cast("array<double>")
    good = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.where(good).select(key, F.transform(v, lambda c: F.floor(c * GRID) + SHIFT).alias("x"))
    lengths = rows.groupBy(F.size("x").alias("d")).count()  # a row for each length met
    top = lengths.orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("x") == (top["d"] if top else 0))


@dataclass(frozen=True)
class Fit:
    """Statistics of the distinct grid vectors: count, exact sums, eigenvalues and unit eigenvectors (falling), trace of the covariance."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def _matrix(col: pa.Array) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)


def _cells(total: np.ndarray) -> pa.RecordBatch:
    """The upper triangle of a matrix of exact integers as rows (i, j, high, low), v = high * 2^40 + low."""
    i, j = np.triu_indices(len(total))
    v = total[i, j]
    high = v >> _LOW
    return pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(high.astype(np.int64), pa.int64()), pa.array((v - (high << _LOW)).astype(np.int64), pa.int64())],
                                      names=["i", "j", "high", "low"])


def _products(y: np.ndarray) -> np.ndarray:
    """y^T y of whole numbers, exactly (floating point where the sums fit, Python's integers beyond)."""
    most = int(np.abs(y).max(initial=0))
    if most * most * max(1, len(y)) < _EXACT:
        f = y.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    z = y.astype(object)
    return z.T @ z


def fit(distinct: DataFrame, max_partials: int = 2048) -> Fit | None:
    """Statistics of the vectors in column ``x``, each there once; None without rows."""
    sums = distinct.select(F.posexplode("x").alias("i", "c")).groupBy("i").agg(F.sum("c").alias("s"), F.count(F.lit(1)).alias("n")).orderBy("i").collect()
    if not sums:
        return None
    n, s = sums[0]["n"], [r["s"] for r in sums]
    middle = [(2 * t + n) // (2 * n) for t in s]  # the mean, rounded: differences from it are small whole numbers
    shift = np.array(middle, np.int64)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for k in range(0, len(batch), ROWS_PER_PRODUCT):
                part = _products(_matrix(batch.column("x").slice(k, ROWS_PER_PRODUCT)).astype(np.int64) - shift)
                total = part if total is None else total + part
        if total is not None:
            yield _cells(total)

    # a task's partial result is one triangle of the matrix, added up by (i, j)
    cells = (distinct.coalesce(max_partials).mapInArrow(products, "i int, j int, high long, low long")
             .groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect())
    d = len(s)
    y = [[0] * d for _ in range(d)]
    for c in cells:
        y[c["i"]][c["j"]] = y[c["j"]][c["i"]] = (c["high"] << _LOW) + c["low"]
    rest = [t - n * m for t, m in zip(s, middle, strict=True)]
    # n^2 times the covariance, exact; then rounded once, in two parts for the extended precision
    exact = [[n * y[i][j] - rest[i] * rest[j] for j in range(d)] for i in range(d)]
    square = n * n
    v = np.array([[_ratio(exact[i][j], square) for j in range(d)] for i in range(d)], np.longdouble)
    trace = sum(exact[i][i] for i in range(d)) / square
    values, vectors = eigenvectors(v)
    real = int((values > trace * d * 2.0**-50).sum()) if trace else 0
    return Fit(n, tuple(s), values[:real].astype(np.float64), vectors[:, :real].astype(np.float64), trace)


def _ratio(a: int, b: int) -> np.longdouble:
    """a / b rounded to extended precision (the double, and the double of what is left)."""
    high = a / b
    p, q = high.as_integer_ratio()
    return np.longdouble(high) + np.longdouble((a * q - p * b) / (b * q))


# ------------------------------------------------------------------ whitening
def _whitener(f: Fit, components: int):
    """x (rows by dimensions, whole numbers) -> its whitened coordinates and the exact squared deviation n x - S."""
    k = min(components, len(f.values))
    project = f.vectors[:, :k] / np.sqrt(f.values[:k])
    n = f.n

    def deviations(x: np.ndarray) -> np.ndarray:
        if int(np.abs(x).max(initial=0)) * n < 1 << 62:
            return n * x - np.array(f.sums, np.int64)
        return n * x.astype(object) - np.array(f.sums, object)

    def whiten(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        d = deviations(x)
        big = int(np.abs(d).max(initial=0))
        squares = (d * d).sum(1) if big * big * x.shape[1] < 1 << 63 else (d.astype(object) ** 2).sum(1)
        return squares, (d / n).astype(np.float64) @ project

    return whiten


def identity_error(distinct: DataFrame, f: Fit, components: int, max_partials: int = 2048) -> float:
    """Largest entry by which the whitened fit vectors' covariance differs from the identity."""
    whiten, k = _whitener(f, components), min(components, len(f.values))

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            for at in range(0, len(batch), ROWS_PER_PRODUCT):
                z = whiten(_matrix(batch.column("x").slice(at, ROWS_PER_PRODUCT)).astype(np.int64))[1]
                first, second = first + z.sum(0), second + z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array([first.tolist()], pa.list_(pa.float64())), pa.array([second.ravel().tolist()], pa.list_(pa.float64()))], names=["first", "second"])

    parts = distinct.coalesce(max_partials).mapInArrow(moments, "first array<double>, second array<double>").collect()
    mean = np.sum([p["first"] for p in parts], 0) / f.n
    cov = np.sum([p["second"] for p in parts], 0).reshape(k, k) / f.n - np.outer(mean, mean)
    return float(np.abs(cov - np.eye(k)).max())


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error) per row and component, numbered from 1."""
    rows = grid(vectors, key, vector)
    kind = rows.schema[key].dataType.simpleString()
    out = f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    distinct = stage(rows.select("x").distinct(), "whitening-fit")
    f = fit(distinct)
    if f is None or not len(f.values):
        return vectors.sparkSession.createDataFrame([], out)
    error, apply, k = identity_error(distinct, f, components), _whitener(f, components), min(components, len(f.values))
    explained = f.values[:k] / f.trace

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), ROWS_PER_PRODUCT):
                part = batch.slice(at, ROWS_PER_PRODUCT)
                squares, z = apply(_matrix(part.column("x")).astype(np.int64))
                m = len(part)
                yield pa.RecordBatch.from_arrays([
                    part.column(key).take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, f.n)), pa.array(np.repeat(squares, k).tolist() if squares.dtype == object else np.repeat(squares, k), pa.int64()),
                    pa.array(z.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                    names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, out)
