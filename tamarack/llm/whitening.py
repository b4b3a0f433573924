"""Whitening of embeddings with eigenvectors that are exact to double precision.

1. Components become integers, so that sums and centred second moments over all rows add up exactly, whatever the order of the tasks.
   Moments are taken about a whole number near the mean, and the rest of the mean is removed from the exact sums.
2. The covariance (dimensions x dimensions, the only thing the driver sees) gets its eigenvectors in float32.
3. Ogita-Aishima steps, matrix products in extended precision alone, double the right digits of the eigenvectors each time. Pairs of
   eigenvalues too close for a step to tell apart form clusters; the covariance projected on a cluster and shifted by its mean is
   solved on its own, which resolves what is small beside the matrix but not beside the cluster.
4. All rows are projected, and the covariance of the result is measured in a pass of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.llm.common import discard, written
from tamarack.llm.topk import integer_vector

#: Components of this size or more in absolute value, as integers, put a vector aside: sums of their products would pass 38 digits.
LARGEST = 2**40

#: Floats hold whole numbers exactly below this.
WHOLE = 2**53

#: Share of the total variance under which an eigenvalue counts as zero, and most refining steps.
ZERO, STEPS = 1e-14, 40

_MOMENTS = "i int, j int, s decimal(38,0)"


def _matrix(batch: pa.RecordBatch, column: str) -> np.ndarray:
    lists = batch.column(column)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1) if len(lists) and len(flat) else np.zeros((len(lists), 0), flat.dtype)


def exact_products(rows: np.ndarray) -> np.ndarray:
    """rows' rows for integer ``rows`` of at most 41 bits, as Python integers where floats would round."""
    d = rows.shape[1]
    largest = int(np.abs(rows).max(initial=0))
    if largest * largest < WHOLE:
        step = max(1, WHOLE // max(1, largest * largest) - 1)
        total = np.zeros((d, d), object)
        for at in range(0, len(rows), step):
            part = rows[at : at + step].astype(np.float64)
            total += (part.T @ part).astype(np.int64)
        return total
    low = rows & (2**21 - 1)
    high = rows >> 21
    cross = np.zeros((d, d), object)
    step = 2**9  # 2 * 21 bits and 9 for the sum
    for at in range(0, len(rows), step):
        a, b = high[at : at + step].astype(np.float64), low[at : at + step].astype(np.float64)
        mixed = (a.T @ b).astype(np.int64).astype(object)
        cross += (a.T @ a).astype(np.int64).astype(object) * 2**42 + (mixed + mixed.T) * 2**21 + (b.T @ b).astype(np.int64)
    return cross


def _row_sums(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[pa.RecordBatch]:
    """Sums of every dimension over a task's rows."""
    total = np.zeros(d, object)
    for batch in batches:
        rows = _matrix(batch, "x")
        for at in range(0, len(rows), 2**20):  # 40 bits and 20 for the sum
            total += rows[at : at + 2**20].sum(axis=0)
    yield _moments(np.zeros(d, np.int32), np.arange(d, dtype=np.int32), total)


def _moments(i: np.ndarray, j: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    exact = pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))
    return pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), exact], ["i", "j", "s"])


def _second_moments(batches: Iterator[pa.RecordBatch], centre: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sums over a task's rows of the products of centred components; the upper triangle."""
    d = len(centre)
    total = np.zeros((d, d), object)
    for batch in batches:
        total += exact_products(_matrix(batch, "x") - centre)
    i, j = np.triu_indices(d)
    yield _moments(i.astype(np.int32), j.astype(np.int32), total[i, j])


def covariance(moments: list[list[int]], rest: list[int], n: int) -> np.ndarray:
    """(n * moments - rest rest') / n^2 in extended precision; the numerator is exact."""
    d = len(rest)
    out = np.zeros((d, d), np.longdouble)
    for i in range(d):
        for j in range(i, d):
            out[i, j] = out[j, i] = np.longdouble(str(n * moments[i][j] - rest[i] * rest[j])) / np.longdouble(str(n * n))
    return out


def _clusters(values: np.ndarray, width: float) -> list[np.ndarray]:
    """Places of values that chains of gaps up to ``width`` join."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > width) + 1
    return [part for part in np.split(order, cuts) if len(part) > 1]


def refined_eigenvectors(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of a symmetric matrix given in extended precision; right to double precision.

    Within a cluster of equal eigenvalues any orthonormal basis is right. Each vector's largest component is positive.
    """
    d = len(matrix)
    scale = np.abs(matrix).max(initial=np.longdouble(0))
    if not d or not scale:
        return np.zeros(d, np.longdouble), np.eye(d, dtype=np.longdouble)
    a = matrix / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    eye = np.eye(d, dtype=np.longdouble)
    size = np.sqrt((a**2).sum())
    done = 8 * d * np.finfo(np.longdouble).eps
    least, stalled = np.inf, 0
    for _ in range(STEPS):
        r = eye - x.T @ x
        s = x.T @ a @ x
        s = (s + s.T) / 2  # steps then keep the vectors orthogonal even where rounding is large beside a gap
        values = np.diag(s) / (1 - np.diag(r))
        reach = 2 * (np.sqrt(((s - np.diag(values)) ** 2).sum()) + size * np.sqrt((r**2).sum()))
        gap = values[None, :] - values[:, None]
        close = np.abs(gap) <= reach
        step = np.where(close, r / 2, (s + values[None, :] * r) / np.where(close, 1, gap))
        x = x + x @ step
        moved = np.abs(step).max()
        for cluster in _clusters(values, reach):
            basis = x[:, cluster]
            shifted = a - values[cluster].mean() * eye
            small = basis.T @ shifted @ basis
            most = np.abs(small).max()
            if most > done:
                turn = np.linalg.eigh(((small + small.T) / (2 * most)).astype(np.float64))[1]
                x[:, cluster] = basis @ turn.astype(np.longdouble)
                moved = max(moved, np.abs(small - np.diag(np.diag(small))).max())
        least, stalled = (moved, 0) if moved < least / 2 else (least, stalled + 1)
        if moved <= done or stalled == 3:  # what still moves within a cluster is the rounding of the matrix itself
            break
    x = x + x @ (eye - x.T @ x) / 2
    values = np.einsum("ij,ij->j", x, a @ x) / np.einsum("ij,ij->j", x, x)
    order = np.argsort(-values, kind="stable")
    x = x[:, order] / np.sqrt((x[:, order] ** 2).sum(axis=0))
    x = x * np.where(x[np.abs(x).argmax(axis=0), np.arange(d)] < 0, -1, 1)
    return np.maximum(values[order], 0) * scale, x


def _projected(batches: Iterator[pa.RecordBatch], n: int, sums: list[int], axes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """vec_id, exact deviation and whitened components; ``axes`` are eigenvectors over the root of their eigenvalue."""
    total = np.array(sums, object)
    for batch in batches:
        rows = _matrix(batch, "x")
        largest = (int(np.abs(rows).max(initial=0)) + max(abs(int(s)) // n + 1 for s in sums)) * n
        if largest * largest * len(sums) < 2**62:
            away = n * rows - total.astype(np.int64)
            exact = (away**2).sum(axis=1)
        else:
            away = n * rows.astype(object) - total
            exact = (away**2).sum(axis=1)
        centred = (away.astype(np.longdouble) / n).astype(np.float64)
        flat = (centred @ axes).ravel()
        borders = np.arange(len(rows) + 1, dtype=np.int32) * axes.shape[1]
        whole = pa.array([Decimal(int(v)) if abs(int(v)) < 10**38 else None for v in exact], pa.decimal128(38, 0))
        lists = pa.ListArray.from_arrays(pa.array(borders), pa.array(flat))
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), whole, lists], ["vec_id", "deviation", "whitened"])


def _gram(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Sums and sums of products of whitened components over a task's rows; sums have i = -1."""
    sums, products = np.zeros(k), np.zeros((k, k))
    for batch in batches:
        rows = _matrix(batch, "whitened").reshape(-1, k)
        sums += rows.sum(axis=0)
        products += rows.T @ rows
    i, j = np.triu_indices(k)
    i, j = np.concatenate([np.full(k, -1), i]).astype(np.int32), np.concatenate([np.arange(k), j]).astype(np.int32)
    values = np.concatenate([sums, products[np.triu_indices(k)]])
    yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(values)], ["i", "j", "s"])


def _identity_error(table: DataFrame, n: int, k: int) -> float:
    """Largest entry of the whitened rows' covariance minus the identity."""
    if not k:
        return 0.0
    parts = table.select("whitened").mapInArrow(lambda b: _gram(b, k), "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
    sums, products = np.zeros(k), np.zeros((k, k))
    for i, j, s in parts.collect():  # k * (k + 3) / 2 rows
        if i < 0:
            sums[j] = s
        else:
            products[i, j] = products[j, i] = s
    mean = sums / n
    return float(np.abs(products / n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(
    vectors: DataFrame, components: int = 32, embedding: str = "embedding", scale: int = 64, shift: int = 1_000_000
) -> DataFrame:
    """vec_id, component (from 1), n, deviation (decimal), whitened, explained and identity_error of every vector.

    Works on x = floor(scale * c) + shift. Left out are vectors that are null, empty, or hold null or non-finite components or ones
    of 2^40 / scale or more, and vectors of another length than most vectors have (of equally many, the longest). Rows without
    vec_id and repeated rows count and are returned like any other. Components whose variance is zero (fewer vectors than
    dimensions, constant or dependent dimensions) cannot get variance one: their ``whitened`` is null, they explain nothing and are
    left out of ``identity_error``. Other columns of the table are not read. No vectors give no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", integer_vector(embedding, scale).alias("x"))
    rows = rows.where(F.col("x").isNotNull() & (F.size("x") > 0) & ~F.exists("x", lambda v: F.abs(v) >= LARGEST))
    rows = written(rows, "integers")
    common = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if common is None:
        return spark.createDataFrame([], schema)
    d, n = common
    fit = rows.where(F.size("x") == d)
    sums = [0] * d  # of x without the shift, which all differences lose
    added = fit.select("x").mapInArrow(lambda b: _row_sums(b, d), _MOMENTS).groupBy("j").agg(F.sum("s").alias("s"))
    for j, s in added.collect():  # one row per dimension
        sums[j] = int(s)
    centre = [(2 * s + n) // (2 * n) for s in sums]
    whole = np.array(centre, np.int64)
    moments = [[0] * d for _ in range(d)]
    added = fit.select("x").mapInArrow(lambda b: _second_moments(b, whole), _MOMENTS).groupBy("i", "j").agg(F.sum("s").alias("s"))
    for i, j, s in added.collect():  # one row per pair of dimensions
        moments[i][j] = int(s)
    matrix = covariance(moments, [s - n * c for s, c in zip(sums, centre)], n)
    values, axes = refined_eigenvectors(matrix)
    trace = np.trace(matrix)
    k = min(components, d)
    live = int((values[:k] > ZERO * trace).sum()) if trace > 0 else 0
    scaled = (axes[:, :live] / np.sqrt(values[:live])).astype(np.float64)
    out = fit.mapInArrow(lambda b: _projected(b, n, sums, scaled), "vec_id long, deviation decimal(38,0), whitened array<double>")
    out = written(out, "whitened")
    discard(rows)
    error = _identity_error(out, n, live)
    shares = [float(v / trace) if c < live else 0.0 for c, v in enumerate(values[:k])]
    each = F.sequence(F.lit(1), F.lit(k))
    rows = out.select("vec_id", "deviation", "whitened", F.explode(each).alias("component"))
    return rows.select(
        "vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation",
        F.when(F.col("component") <= live, F.get("whitened", F.col("component") - 1)).alias("whitened"),
        F.element_at(F.array(*map(F.lit, shares)), F.col("component")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
