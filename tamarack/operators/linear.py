"""Many linear models over the same rows, fitted at a time.

All models step together: a pass over the rows gives the loss and the gradient of every model that waits for them, as two products of
a block of rows with the models' coefficients inside the tasks, added up in a tree. The rows are read as often as the slowest model asks,
not once per model and step. On the driver are a few numbers per model and feature.

Objectives, start and stopping rule are those of Spark's ``LogisticRegression`` (``standardization=False``) and ``LinearSVC``: weighted mean
loss plus penalty, L-BFGS over standardised features with ten corrections, orthant-wise where there is an L1 part (Andrew & Gao, 2007).
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Generator, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.operators.blocks import sum_blocks
from tamarack.session import partitions_by_bytes

#: Bytes of the sums that a task sends in one pass; more models are taken in several passes.
PASS_BYTES = 16 * 2**20

#: Values of a product of rows and models that a task holds at a time.
BLOCK_VALUES = 1 << 20

#: Least bytes of a partition: small tables are spread over the slots all the same.
LEAST_BYTES = 256 * 2**10

CORRECTIONS, REMEMBERED, HALVINGS = 10, 20, 30


@dataclass(frozen=True)
class Problem:
    """One model: ``hinge`` or logistic loss, strength and L1 share of the penalty, and the rows it is trained on.

    Rows of another fold than ``fold`` are trained on whose place is below ``share``. ``strength`` is the penalty of each of n rows
    where ``per_row`` is set (C * n times smaller than 1), else the penalty itself.
    """

    hinge: bool
    strength: float
    mix: float
    balanced: bool
    tol: float
    max_iter: int
    fold: int
    share: float = 2.0
    per_row: bool = True


def minimise(x: np.ndarray, l1: np.ndarray, max_iter: int, tol: float) -> Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]:
    """L-BFGS, orthant-wise where ``l1`` is not 0: yields points, is sent (value, gradient) of the smooth part, returns the best point."""
    value, slope = yield x
    value += float(l1 @ np.abs(x))
    scale, recent, pairs = abs(value), deque([value], maxlen=REMEMBERED), deque(maxlen=CORRECTIONS)
    for turn in range(max_iter):
        steep = _pseudo(x, slope, l1)
        if np.linalg.norm(steep) <= max(tol * abs(value), 1e-8):
            break
        while True:
            way = -_two_loops(steep, pairs)
            way = np.where((l1 > 0) & (way * steep >= 0), 0.0, way)
            falls = float(way @ steep)
            if falls < 0 or not pairs:
                break
            pairs.clear()
        if falls >= 0:
            break
        orthant = np.where(x != 0, np.sign(x), -np.sign(steep))
        step, found = (1.0 if pairs else min(1.0, 1.0 / np.linalg.norm(way))), None
        for _ in range(HALVINGS):
            there = x + step * way
            there = np.where((l1 > 0) & (there * orthant < 0), 0.0, there)
            smooth, gradient = yield there
            total = smooth + float(l1 @ np.abs(there))
            if np.isfinite(total) and total <= value + 1e-4 * float(steep @ (there - x)):
                found = there, total, gradient
                break
            step /= 2
        if found is None:
            if not pairs:
                break
            pairs.clear()  # once more along the gradient
            continue
        there, total, gradient = found
        moved, bent = there - x, gradient - slope
        if moved @ bent > 1e-12 * np.linalg.norm(moved) * np.linalg.norm(bent):
            pairs.append((moved, bent, 1.0 / (moved @ bent)))
        x, value, slope = there, total, gradient
        recent.append(value)
        if abs(value - max(recent)) <= tol * scale:
            break
    return x


def _pseudo(x: np.ndarray, slope: np.ndarray, l1: np.ndarray) -> np.ndarray:
    up, down = slope + l1, slope - l1
    at_zero = np.where(up < 0, up, np.where(down > 0, down, 0.0))
    return np.where(x != 0, slope + np.sign(x) * l1, at_zero)


def _two_loops(slope: np.ndarray, pairs: Sequence[tuple[np.ndarray, np.ndarray, float]]) -> np.ndarray:
    out, parts = slope.copy(), []
    for moved, bent, rho in reversed(pairs):
        parts.append(rho * (moved @ out))
        out -= parts[-1] * bent
    if pairs:
        moved, bent, rho = pairs[-1]
        out /= rho * (bent @ bent)
    for (moved, bent, rho), part in zip(pairs, reversed(parts)):
        out += (part - rho * (bent @ out)) * moved
    return out


class Rows:
    """(label, fold, place, features) of a written table, held for many passes; use it in a ``with`` statement.

    Features are taken relative to their mean over all rows, which keeps the sums exact enough for any scale.
    """

    def __init__(self, table: DataFrame, label: str, features: str) -> None:
        slots = table.sparkSession.sparkContext.defaultParallelism
        parts = max(partitions_by_bytes(table), min(slots, partitions_by_bytes(table, LEAST_BYTES)))
        arrays = table.select(F.col(label).cast("double").alias("y"), F.col("fold").cast("int"), F.col("place").cast("double"), vector_to_array(features).alias("x"))
        self.frame = arrays.repartition(parts).persist(StorageLevel.MEMORY_AND_DISK)
        self.parts = parts
        first = self.frame.first()
        self.width = len(first["x"]) if first else 0
        self.shift = np.zeros(self.width)
        sums = self.added(lambda x, y, fold, place: np.append(x.sum(0), len(y)), (self.width + 1,))
        self.shift = sums[:-1] / max(sums[-1], 1.0)

    def __enter__(self) -> Rows:
        return self

    def __exit__(self, *_) -> None:
        self.frame.unpersist()

    def added(self, part: Callable, shape: tuple[int, ...], rows: int = 4096) -> np.ndarray:
        """The sum of ``part(x, y, fold, place)`` over blocks of at most ``rows`` rows."""
        shift, width = self.shift, self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape)
            for batch in batches:
                y, fold, place, x = (batch.column(i) for i in range(4))
                y, fold, place = (c.to_numpy(zero_copy_only=False) for c in (y, fold, place))
                x = x.flatten().to_numpy(zero_copy_only=False).reshape(len(y), width)
                for at in range(0, len(y), rows):
                    cut = slice(at, at + rows)
                    total += part(x[cut] - shift, y[cut], fold[cut], place[cut])
            yield pa.RecordBatch.from_pydict({"m": pa.array([total.tobytes()], pa.binary())})

        return sum_blocks(self.frame.mapInArrow(run, "m binary"), self.parts, shape)


def _trains(fold: np.ndarray, place: np.ndarray, folds: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """1.0 where a row is one of a model's training rows."""
    return ((fold[:, None] != folds) & (place[:, None] < shares)).astype(float)


def _subsets(rows: Rows, pairs: list[tuple[int, float]]) -> dict[tuple[int, float], np.ndarray]:
    """Per training set and class: the row count, then sums and sums of squares of the features."""
    folds, shares = (np.array(v) for v in zip(*pairs))
    width = rows.width

    def part(x: np.ndarray, y: np.ndarray, fold: np.ndarray, place: np.ndarray) -> np.ndarray:
        taken = _trains(fold, place, folds, shares)
        out = np.empty((len(pairs), 2, 1 + 2 * width))
        for c in (0, 1):
            own = taken[y == c]
            out[:, c, 0] = own.sum(0)
            out[:, c, 1 : 1 + width] = own.T @ x[y == c]
            out[:, c, 1 + width :] = own.T @ x[y == c] ** 2
        return out

    return dict(zip(pairs, rows.added(part, (len(pairs), 2, 1 + 2 * width))))


class _Model:
    """A problem over standardised features: its weights, its scales and the optimiser that waits for sums."""

    def __init__(self, problem: Problem, sums: np.ndarray) -> None:
        counts = sums[:, 0]
        n, classes = counts.sum(), int((counts > 0).sum())
        if n == 0:
            raise ValueError("no rows to train on")
        width = (sums.shape[1] - 1) // 2
        self.problem, self.rows = problem, n
        self.weights = np.where(counts > 0, n / (classes * np.maximum(counts, 1)), 0.0) if problem.balanced else np.ones(2)
        total = float(self.weights @ counts)
        mean = (self.weights @ sums[:, 1 : 1 + width]) / total
        spread = (self.weights @ sums[:, 1 + width :]) - total * mean**2
        spread = np.sqrt(np.clip(spread, 0, None) / max(total - float(self.weights**2 @ counts) / total, 1e-300))
        self.total, self.mean = total, mean
        level = 1e-9 * np.sqrt((self.weights @ sums[:, 1 + width :]) / total)
        self.inverse = np.where(spread > level, 1.0 / np.where(spread > 0, spread, 1.0), 0.0)  # features that do not vary stay out
        strength = 1.0 / (problem.strength * n) if problem.per_row else problem.strength
        unit = np.ones(width) if problem.hinge else self.inverse  # the margin's penalty is on standardised features, the logistic one on plain
        self.l2 = np.append(strength * (1 - problem.mix) * unit**2, 0.0)
        l1 = np.append(strength * problem.mix * unit, 0.0)
        start = np.zeros(width + 1)
        self.point: np.ndarray | None = None
        self.constant = None
        if not problem.hinge:
            if classes < 2:
                self.constant = np.append(np.zeros(width), np.inf if counts[1] else -np.inf)
                return
            start[-1] = np.log(self.weights[1] * counts[1] / (self.weights[0] * counts[0]))
        self.best, self.steps = start, minimise(start, l1, problem.max_iter, problem.tol)
        self.point = next(self.steps)

    def plain(self, point: np.ndarray) -> np.ndarray:
        """Coefficients and intercept for features as the tasks have them."""
        coefficients = point[:-1] * self.inverse
        return np.append(coefficients, point[-1] - coefficients @ self.mean)

    def take(self, loss: float, slope: np.ndarray) -> None:
        """Sums over the rows for the point that waits: on to the next one, or to the end."""
        point = self.point
        value = loss / self.total + 0.5 * float(self.l2 @ point**2)
        gradient = np.append(self.inverse * (slope[:-1] - self.mean * slope[-1]), slope[-1]) / self.total + self.l2 * point
        try:
            self.point = self.steps.send((value, gradient))
        except StopIteration as end:
            self.best, self.point = end.value, None

    def fitted(self) -> np.ndarray:
        return self.constant if self.constant is not None else self.plain(self.best)


def _model(problem: Problem, sums: np.ndarray) -> _Model | ValueError:
    try:
        return _Model(problem, sums)
    except ValueError as error:
        return error


def _groups(count: int, numbers: int) -> Iterator[slice]:
    size = max(1, PASS_BYTES // (8 * numbers))
    return (slice(at, at + size) for at in range(0, count, size))


def _pass(rows: Rows, models: Sequence[_Model]) -> None:
    """One reading of the rows for every model that waits."""
    matrix = np.stack([m.plain(m.point) for m in models], 1)
    low, high = (np.array([m.weights[c] for m in models]) for c in (0, 1))
    folds, shares = (np.array([getattr(m.problem, k) for m in models]) for k in ("fold", "share"))
    hinge = models[0].problem.hinge
    width = rows.width

    def part(x: np.ndarray, y: np.ndarray, fold: np.ndarray, place: np.ndarray) -> np.ndarray:
        sign = np.where(y == 1, 1.0, -1.0)[:, None]
        weight = np.where(y[:, None] == 1, high, low) * _trains(fold, place, folds, shares)
        margin = sign * (x @ matrix[:-1] + matrix[-1])
        if hinge:
            lost, pull = np.maximum(0.0, 1.0 - margin), (margin < 1.0).astype(float)
        else:
            small = np.exp(-np.abs(margin))
            lost = np.log1p(small) + np.maximum(0.0, -margin)
            pull = np.where(margin > 0, small, 1.0) / (1.0 + small)
        pull *= -sign * weight
        return np.vstack([(weight * lost).sum(0), x.T @ pull, pull.sum(0)])

    sums = rows.added(part, (width + 2, len(models)), max(1, BLOCK_VALUES // len(models)))
    for k, model in enumerate(models):
        model.take(float(sums[0, k]), sums[1:, k])


def fit_linear(rows: Rows, problems: Sequence[Problem]) -> list[np.ndarray | ValueError]:
    """Coefficients and intercept of every problem, for features less ``rows.shift``; an error for a problem without rows."""
    if not problems:
        return []
    trained = sorted({(p.fold, p.share) for p in problems})
    sums = {}
    for group in _groups(len(trained), 2 * (1 + 2 * rows.width)):
        sums |= _subsets(rows, trained[group])
    models = [_model(p, sums[p.fold, p.share]) for p in problems]
    waiting = [m for m in models if isinstance(m, _Model) and m.point is not None]
    while waiting:
        for group in _groups(len(waiting), rows.width + 2):
            _pass(rows, waiting[group])
        waiting = [m for m in waiting if m.point is not None]
    return [m.fitted() if isinstance(m, _Model) else m for m in models]


def confusions(rows: Rows, problems: Sequence[Problem], found: Sequence[np.ndarray]) -> np.ndarray:
    """Per problem: true negatives, false positives, false negatives, true positives on its training rows, then on its fold."""
    out = []
    for group in _groups(len(problems), max(8, rows.width + 2)):
        matrix = np.stack(found[group], 1)
        folds, shares = (np.array([getattr(p, k) for p in problems[group]]) for k in ("fold", "share"))

        def part(x: np.ndarray, y: np.ndarray, fold: np.ndarray, place: np.ndarray) -> np.ndarray:
            says = (x @ matrix[:-1] + matrix[-1]) > 0
            cells = []
            for taken in (_trains(fold, place, folds, shares) > 0, fold[:, None] == folds):
                cells += [(taken & (y[:, None] == a) & (says == bool(b))).sum(0) for a in (0, 1) for b in (0, 1)]
            return np.array(cells, dtype=float)

        out.append(rows.added(part, (8, matrix.shape[1]), max(1, BLOCK_VALUES // matrix.shape[1])).T)
    return np.concatenate(out)


def scores_of(cells: np.ndarray) -> tuple[float, float]:
    """F1 of class 1 and balanced accuracy from (tn, fp, fn, tp); 0 where a share has no rows, as :func:`metrics.binary_scores`."""
    tn, fp, fn, tp = map(float, cells)
    f1 = 2 * tp / (2 * tp + fp + fn) if 2 * tp + fp + fn else 0.0
    return f1, ((tp / (tp + fn) if tp + fn else 0.0) + (tn / (tn + fp) if tn + fp else 0.0)) / 2
