"""Whitening of embeddings: principal components by a randomised range finder with Rayleigh-Ritz.

A random basis of the wanted components and ``OVERSAMPLED`` more is multiplied by the covariance in passes
over all centred rows; after each pass the basis is made orthonormal again, and a small eigenproblem within it
(Rayleigh-Ritz) gives components with their residuals. When the residuals would not reach ``CLOSE`` of the greatest
eigenvalue within ``PASSES`` passes, as judged by how fast they shrink, the basis is expanded to the full
dimension, where one pass is exact to rounding. Every pass sums matrices of (dimension x basis) numbers in tasks and
adds them up in a tree of ``FAN_IN`` at a time, so the driver gets one matrix, however many tasks there are.

Entries are integers ``floor(64 c) + 1000000``; their sums are exact. Rows are centred by the whole and the broken
part of the mean apart, which loses no digits to the offset.

Cases: rows whose vector is null, or holds null or non-finite entries, are dropped; vectors shorter than the longest
count as 0 at its further entries; entries are cut at 2^34 in size, so that sums stay exact; rows without an
id stay, and repeated rows are rows of their own; components without variance (beyond rounding) have no whitened
value and are left out, so equal vectors, or a single one, give no rows; an empty table gives an empty result;
``deviation`` is null where it exceeds a long; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import bounded, materialize

COMPONENTS, OVERSAMPLED, PASSES, CLOSE = 32, 10, 5, 1e-13
SCALE, OFFSET, LARGEST = 64, 1_000_000, float(1 << 34)
#: Partial matrices that one task adds up.
FAN_IN = 32


class Fit(NamedTuple):
    """What whitening needs: rows, sums by dimension, components as columns, their eigenvalues, the covariance's trace, and how the basis was found."""

    n: int
    sums: list[int]
    axes: np.ndarray
    values: np.ndarray
    trace: float
    passes: int
    expanded: bool


def entries(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and x (the integer entries) of the rows that have a vector of finite entries."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform("v", lambda c: F.floor(F.greatest(F.least(c, F.lit(LARGEST)), F.lit(-LARGEST)) * SCALE) + OFFSET)
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).filter(F.col("v").isNotNull() & finite).select("vec_id", whole.alias("x"))


def _rows(x: pa.Array, dim: int) -> np.ndarray:
    """The entries as a matrix; shorter vectors are filled up with the entry of 0."""
    flat, sizes = x.flatten().to_numpy(zero_copy_only=False), x.value_lengths().to_numpy(zero_copy_only=False)
    if (sizes == dim).all():
        return flat.reshape(-1, dim)
    out = np.full((len(sizes), dim), OFFSET, np.int64)
    out[np.arange(dim) < sizes[:, None]] = flat
    return out


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], np.float64) / n
    return (x - whole) - rest


def _added(rows: DataFrame, shape: tuple[int, int], part: Callable[[np.ndarray], np.ndarray], dim: int) -> np.ndarray:
    """The sum of ``part`` over all batches of rows: one matrix a task, added up in a tree."""

    def total(found: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(shape)
        for a in found:
            out += a
        yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], ["m"])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from total(part(_rows(b.column("x"), dim)) for b in batches if b.num_rows)

    def further(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from total(np.frombuffer(m, np.float64).reshape(shape) for b in batches for m in b.column("m").to_pylist())

    parts, found = rows.rdd.getNumPartitions(), bounded(rows).mapInArrow(first, "m binary")
    while parts > 1:
        parts = -(-parts // FAN_IN)
        found = found.repartition(parts).mapInArrow(further, "m binary")
    return sum((np.frombuffer(r["m"], np.float64).reshape(shape) for r in found.collect()), np.zeros(shape))


def _sums(rows: DataFrame, dim: int) -> list[int]:
    """Exact sums by dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim)), pa.array(_rows(b.column("x"), dim).sum(axis=0))], ["at", "s"])

    found = bounded(rows).mapInArrow(run, "at long, s long").groupBy("at").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    return [int(s) for _, s in sorted((r["at"], r["s"]) for r in found)]


def _oriented(axes: np.ndarray) -> np.ndarray:
    """Each column with its largest entry above 0."""
    return axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])])


def fit(rows: DataFrame, components: int = COMPONENTS, *, oversampled: int = OVERSAMPLED, passes: int = PASSES, close: float = CLOSE, seed: int = 7) -> Fit | None:
    """Components of all ``rows`` (of ``entries``); None if there is no row, or none with an entry."""
    n, dim = rows.agg(F.count("*"), F.max(F.size("x"))).first()
    if not n or not dim:
        return None
    sums = _sums(rows, dim)
    width = min(dim, components + oversampled)
    basis = np.eye(dim) if width == dim else np.linalg.qr(np.random.RandomState(seed).randn(dim, width))[0]
    worst: list[float] = []
    for k in range(1, passes + 2):
        q = basis

        def part(x: np.ndarray, q: np.ndarray = q) -> np.ndarray:
            c = _centred(x, n, sums)
            return np.vstack([c.T @ (c @ q), np.full((1, q.shape[1]), np.einsum("ij,ij->", c, c))])

        found = _added(rows, (dim + 1, q.shape[1]), part, dim) / n
        image, trace = found[:-1], float(found[-1, 0])
        small = q.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        axes = q @ turn
        kept = slice(0, min(components, len(values)))
        worst.append(float(np.linalg.norm(image @ turn[:, kept] - axes[:, kept] * values[kept], axis=0).max()) / max(float(values[0]), np.finfo(float).tiny))
        full = q.shape[1] == dim
        if full or worst[-1] <= close:
            break
        pace = worst[-1] / worst[-2] if k > 1 else 0.0
        if k >= passes or worst[-1] * pace ** (passes - k) > close:
            basis = np.eye(dim)
        else:
            basis = np.linalg.qr(image)[0]
    least = max(float(values[0]), 0.0) * dim * np.finfo(float).eps * 4
    some = np.flatnonzero(values[:components] > least)
    return Fit(n, sums, _oriented(axes[:, some]), values[some], trace, k, full and width < dim)


def _deviation(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over the dimensions of (n x - S)^2, exactly; null beyond a long."""
    whole, rest = np.array([s // n for s in sums], np.int64), np.array([s % n for s in sums], np.int64)
    away = x - whole
    most = (int(np.abs(away).max(initial=0)) + 1) * n
    if most * most * x.shape[1] < 1 << 63:
        d = away * n - rest
        return (d * d).sum(axis=1).tolist()
    d = away.astype(object) * n - rest.astype(object)
    return [int(s) if s < 1 << 63 else None for s in (d * d).sum(axis=1)]


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error: a row for each vector and component."""
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = materialize(entries(vectors, id_col, vector_col), "entries")
    found = fit(rows, components)
    if found is None or not len(found.values):
        return vectors.sparkSession.createDataFrame([], schema)
    n, sums, dim, k = found.n, found.sums, len(found.sums), len(found.values)
    turn = found.axes / np.sqrt(found.values)

    def spread(x: np.ndarray) -> np.ndarray:
        w = _centred(x, n, sums) @ turn
        return np.vstack([w.T @ w, w.sum(axis=0)])

    seen = _added(rows, (k + 1, k), spread, dim) / n
    error = float(np.abs(seen[:-1] - np.outer(seen[-1], seen[-1]) - np.eye(k)).max())
    explained = found.values / found.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _rows(b.column("x"), dim)
            m = len(x)
            each = pa.array(np.repeat(np.arange(m), k))
            columns = [
                b.column("vec_id").take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)), pa.array(_deviation(x, n, sums), pa.int64()).take(each),
                pa.array((_centred(x, n, sums) @ turn).reshape(-1)), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return bounded(rows).mapInArrow(run, schema)
