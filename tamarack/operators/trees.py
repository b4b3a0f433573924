"""Many forests, boosted trees and AdaBoost models over one table, each fitted to the rules of Spark's trees.

While the rows of a fit stay below ``FIT_BYTES`` they travel to the task that grows its trees, instead of histograms of every node, level and
round travelling to the driver: a group of rows then serves several fits of one fold. Larger tables are left to Spark's own distributed trees,
fit by fit. Of a search's fits only the counts of right and wrong predictions leave a task; of a model that is kept, its nodes become Spark's model.

As in Spark: 32 bins per feature with borders from the training rows (each counted once, where Spark weighs them), features drawn per node, Poisson bags, splits by weighted impurity with
``least`` rows on either side, sibling leaves of one class merged, log loss of ±1 labels for boosting, early stopping on held rows.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from tamarack.session import cut_lineage, fresh_path

#: Bytes of feature values that a group of rows may have, and from which on groups are fewer. A task holds them twice for a moment, as the
#: four bytes that they travel as where these are exact, then as bins of one byte and cells of two.
FIT_BYTES, MANY_BYTES = 512 * 2**20, 32 * 2**20

#: Values of the histograms that a task works on at a time (they should stay in the cache), and of those kept for the next level.
BLOCK_VALUES, LEVEL_VALUES = 1 << 16, 1 << 22

#: Rows that are counted at a time, and rows per node from which on histograms of a level are kept for the next.
CHUNK, KEPT_ROWS = 4096, 48

#: Groups per slot (of many bytes), and groups per Spark job: scores are known, and can be noted, after every job.
GROUPS, MANY_GROUPS, JOB_GROUPS = 8, 3, 2

BINS = 32
SEED = 42


@dataclass(frozen=True)
class Recipe:
    """A fit: ``kind`` is forest, boosted or ada; ``weights`` of the classes, or None for balanced ones; ``tried`` is the share of features
    drawn per node, or sqrt, log2, all; rows whose ``held`` place is below ``held`` stop a boosted fit early."""

    kind: str
    trees: int
    depth: int
    least: int = 1
    tried: str | float = "all"
    weights: tuple[float, float] | None = (1.0, 1.0)
    entropy: bool = False
    bootstrap: bool = False
    rate: float = 1.0
    step: float = 1.0
    held: float | None = None
    tol: float = 0.01

    def __post_init__(self) -> None:
        if self.least < 1 or self.trees < 1 or not 0 <= self.depth <= 30 or not 0 < self.rate <= 1:
            raise ValueError(f"no such trees: {self}")

    def drawn(self, features: int) -> int:
        if isinstance(self.tried, float):
            return max(1, math.ceil(self.tried * features))
        return {"sqrt": math.ceil(math.sqrt(features)), "log2": max(1, math.ceil(math.log2(features))), "all": features}[self.tried]

    @property
    def cost(self) -> float:
        return self.trees * self.depth * (0.2 if self.tried in ("sqrt", "log2") else 1.0)


def borders_of(x: np.ndarray, train: np.ndarray) -> list[np.ndarray]:
    """Borders of the bins of every feature, halfway between values of the training rows."""
    out = []
    for f in range(x.shape[1]):
        seen = np.sort(x[train, f]).astype(float)
        values = seen[np.concatenate([[True], seen[1:] != seen[:-1]])] if len(seen) else seen
        if len(values) <= BINS:
            out.append((values[1:] + values[:-1]) / 2)
        else:
            at = np.floor(np.arange(1, BINS) * (len(seen) / BINS) + 0.5).astype(int)
            out.append(np.unique((seen[at] + seen[at - 1]) / 2))
    return out


def binned(x: np.ndarray, train: np.ndarray, borders: list[np.ndarray] | None = None) -> np.ndarray:
    """Bin of every value: how many borders are less."""
    out = np.empty(x.shape, np.uint8)
    for f, of in enumerate(borders_of(x, train) if borders is None else borders):
        out[:, f] = np.searchsorted(of, x[:, f].astype(float))
    return out


def _xlogx(w: np.ndarray) -> np.ndarray:
    return w * np.log(np.maximum(w, 1e-300))


@dataclass(frozen=True)
class Grown:
    """A tree by its nodes, children after their parents: sums of s, w and c; children (or -1), feature and border of inner nodes."""

    sums: np.ndarray
    left: np.ndarray
    feature: np.ndarray
    border: np.ndarray


class Rows:
    """The binned rows of a fit and the split search over them."""

    def __init__(self, bins: np.ndarray) -> None:
        self.bins, self.features = np.ascontiguousarray(bins), bins.shape[1]
        kind = np.uint16 if self.features * BINS <= 1 << 16 else np.uint32
        self.cells = bins.astype(kind) * kind(self.features)  # bin and column of a value as one number
        self.cells += np.arange(self.features, dtype=kind)
        self.place = np.int32 if bins.size < 1 << 31 else np.intp

    def running(self, rows: np.ndarray, node: np.ndarray, nodes: int, sums_of: Sequence[np.ndarray | None], chosen: np.ndarray | None = None) -> list[np.ndarray]:
        """Sums over the bins up to each, (nodes, bins, features), of values of the rows, or of 1 per row; ``chosen`` features of a node."""
        width = self.features if chosen is None else chosen.shape[1]
        size = BINS * width * nodes
        out = [np.zeros(size, np.intp if v is None else float) for v in sums_of]
        if chosen is not None:
            places, columns = chosen.astype(self.place), (np.arange(width) * nodes + np.arange(nodes)[:, None]).astype(np.int32)
        for low in range(0, len(rows), CHUNK):
            part, of = rows[low : low + CHUNK], node[low : low + CHUNK]
            if chosen is None:
                at = np.multiply(self.cells.take(part, 0), nodes, dtype=np.intp)
                at += of[:, None]
            else:
                values = places.take(of, 0)
                values += (part * self.features).astype(self.place)[:, None]
                at = np.multiply(self.bins.ravel().take(values), width * nodes, dtype=np.intp)
                at += columns.take(of, 0)
            for i, v in enumerate(sums_of):
                found = np.bincount(at.ravel(), None if v is None else np.repeat(v[part], width), minlength=size)
                out[i] = found if low == 0 else np.add(out[i], found, out=out[i])
        for sums in out:
            by_bin = sums.reshape(BINS, -1)
            for b in range(1, BINS):
                by_bin[b] += by_bin[b - 1]
        return [np.ascontiguousarray(np.moveaxis(sums.reshape(BINS, width, nodes), 2, 0)) for sums in out]

    def grow(
        self, w: np.ndarray, s: np.ndarray, c: np.ndarray, recipe: Recipe, rng: np.random.Generator, classes: bool, by_class: tuple[float, float] | None = None
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A tree: the leaf of every row, trained on or not, and sums of s and w per node."""
        leaf, tree = self.tree(w, s, c, recipe, rng, classes, by_class)
        return leaf, tree.sums[:, 0], tree.sums[:, 1]

    def tree(
        self, w: np.ndarray, s: np.ndarray, c: np.ndarray, recipe: Recipe, rng: np.random.Generator, classes: bool, by_class: tuple[float, float] | None = None
    ) -> tuple[np.ndarray, Grown]:
        """The leaf of every row, and the tree. c counts, w weighs, s is w times target, above 0 for rows of class 1 alone; rows with a
        count of 0 are not trained on. Where w is c times a weight of the row's class, these weights are ``by_class``."""
        if by_class is None and (w == c).all():
            by_class = (1.0, 1.0)
        leaf = np.zeros(len(c), np.intp)
        rows, node, ids = np.arange(len(c)), np.zeros(len(c), np.intp), np.zeros(1, np.intp)
        sums = np.array([[s.sum(), w.sum(), c.sum()]])
        search = _Search(self, w, s, c, recipe, classes, by_class)
        parents = []
        for _ in range(recipe.depth):
            level = sums[ids]
            open_ = level[:, 2] >= max(2, 2 * recipe.least)
            if classes:
                rest = level[:, 1] - level[:, 0]
                open_ &= (level[:, 0] > 1e-12 * level[:, 1]) & (rest > 1e-12 * level[:, 1])
            rows, node, ids = _only(rows, node, ids, open_)
            if not len(ids):
                break
            feature, border, splits = search.level(rows, node, len(ids), open_, rng)
            kept = np.flatnonzero(splits)
            rows, node, ids = _only(rows, node, ids, splits)
            if not len(ids):
                break
            feature, border = feature[kept], border[kept]
            right = self.bins[rows, feature[node]] > border[node]
            node = 2 * node + right
            new = len(sums) + np.arange(2 * len(ids))
            leaf[rows] = new[node]
            trained = c[rows] > 0
            r, at = rows[trained], node[trained]
            sums = np.concatenate([sums, np.stack([np.bincount(at, v[r], minlength=len(new)) for v in (s, w, c)], 1)])
            parents.append((ids, new, feature, border))
            ids = new
        left, at, of = np.full(len(sums), -1), np.zeros(len(sums), np.intp), np.zeros(len(sums), np.intp)
        for ids, new, feature, border in parents:
            left[ids], at[ids], of[ids] = new[::2], feature, border
        if classes:
            stands = _merged(sums, [p[:2] for p in parents])
            leaf, left = stands[leaf], np.where(stands[left] == left, left, -1)
        return leaf, Grown(sums, left, at, of)


class _Search:
    """The best splits of a tree's levels. Where nodes have many rows, the sums of the larger child are those of its parent less those of its sibling."""

    def __init__(
        self, rows: Rows, w: np.ndarray, s: np.ndarray, c: np.ndarray, recipe: Recipe, classes: bool, by_class: tuple[float, float] | None
    ) -> None:
        self.rows, self.recipe, self.by_class, self.c = rows, recipe, by_class, c
        self.counts = by_class is not None and classes  # sums of whole rows, each as often as it counts
        self.positive = s > 0
        both = by_class is not None and by_class[0] != by_class[1]
        # (rows of class 1 only, values) of every sum: counts or weights by class, or counts, targets and counts of class 1
        if classes:
            v = None if self.counts else w
            self.sums = [(False, v), (True, v)] + ([(False, None)] if v is not None and recipe.least > 1 else [])
        elif by_class is not None:
            self.sums = [(False, None), (False, s)] + ([(True, None)] if both else [])
        else:
            self.sums = [(False, None), (False, s), (False, w)]
        self.classes = classes
        if recipe.entropy and self.counts:
            n = np.arange(int(c.sum()) + 1.0)
            self.tables = [_xlogx(n * a) for a in by_class]
        self.before: tuple | None = None

    def _sums(self, r: np.ndarray, at: np.ndarray, nodes: int, chosen: np.ndarray | None = None) -> list[np.ndarray]:
        out: list = [None] * len(self.sums)
        for positive in (False, True):
            mine = [i for i, (p, _) in enumerate(self.sums) if p == positive]
            if mine:
                take = self.positive[r] if positive else slice(None)
                for i, found in zip(mine, self.rows.running(r[take], at[take], nodes, [self.sums[i][1] for i in mine], chosen)):
                    out[i] = found
        return out

    def level(self, rows: np.ndarray, node: np.ndarray, nodes: int, open_: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Feature, last bin to the left and whether to split at all, for nodes 0 to ``nodes`` of the rows, those of the level that are open."""
        width = self.rows.features
        tried = self.recipe.drawn(width)
        chosen = np.argpartition(rng.random((nodes, width)), tried - 1, axis=1)[:, :tried] if tried < width else None
        trained = self.c[rows] > 0
        r, at = rows[trained], node[trained]
        order = np.argsort(at.astype(np.uint16) if nodes <= 1 << 16 else at, kind="stable")
        r, at = r[order], at[order]
        if self.counts:
            often = self.c[r].astype(np.intp)
            r, at = np.repeat(r, often), np.repeat(at, often)
        ends = np.searchsorted(at, np.arange(nodes + 1))
        few = chosen is not None and 2 * tried <= width
        step = max(2, BLOCK_VALUES // ((tried if few else width) * BINS))
        keep = not few and nodes * width * BINS <= LEVEL_VALUES and len(r) >= KEPT_ROWS * nodes
        held = [np.empty((nodes, BINS, width), np.intp if v is None else float) for _, v in self.sums] if keep else None
        found = []

        def settle(low: int, high: int, sums: list[np.ndarray]) -> None:
            if held is not None:
                for a, b in zip(held, sums):
                    a[low:high] = b
            mine = None if chosen is None else chosen[low:high]
            found.append(self._best(sums, mine, few))

        if self.before is not None and not few and len(r) >= KEPT_ROWS * nodes:
            whole, kept = self.before
            number = np.cumsum(open_) - 1  # of every child among the open ones
            size = np.zeros(len(open_), np.intp)
            size[open_] = np.diff(ends)
            closed = size == 0
            size[closed] = np.iinfo(np.intp).max  # rows of closed children are not at hand
            smaller = 2 * np.arange(len(kept)) + (size[1::2] < size[::2])
            some = np.flatnonzero(open_.reshape(-1, 2).any(1))
            half = max(1, step // 2)
            for at_low in range(0, len(some), half):
                p = some[at_low : at_low + half]
                small = number[smaller[p]]
                take = np.concatenate([np.arange(ends[i], ends[i + 1]) for i in small])
                part = self._sums(r[take], np.repeat(np.arange(len(p)), ends[small + 1] - ends[small]), len(p))
                child = np.stack([2 * p, 2 * p + 1], 1)
                is_open, is_small = open_[child].ravel(), (child == smaller[p][:, None]).ravel()
                of = np.repeat(np.arange(len(p)), 2)[is_open]
                is_small = is_small[is_open]
                sums = []
                for a, b in zip(whole, part):
                    both = b[of]
                    both[~is_small] = a[kept[p[of[~is_small]]]] - both[~is_small]
                    sums.append(both)
                first = number[child.ravel()[is_open][0]]
                settle(first, first + len(of), sums)
        else:
            for low in range(0, nodes, step):
                high = min(low + step, nodes)
                part = slice(ends[low], ends[high])
                settle(low, high, self._sums(r[part], at[part] - low, high - low, chosen[low:high] if few else None))
        feature, border, splits = (np.concatenate(v) for v in zip(*found))
        self.before = (held, np.flatnonzero(splits)) if keep else None
        return feature, border, splits

    def _best(self, sums: list[np.ndarray], chosen: np.ndarray | None, few: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        least = self.recipe.least
        with np.errstate(divide="ignore", invalid="ignore"):  # borders without rows on one side are ruled out by their counts
            if self.recipe.entropy and self.counts:
                good, whole = self._entropies(*sums)
            else:
                w, s = self._weights(sums)
                left, every, total = w[:, :-1], w[:, -1:, :1], s[:, -1:, :1]
                good = left * (total / every)
                np.subtract(s[:, :-1], good, out=good)
                good *= good
                rest = every - left
                rest *= left
                good /= rest
                good *= every
                whole = (total * total / every).ravel()
            if self.classes and not self.counts:
                w = sums[0]
                off = 1e-12 * w[:, -1:, :1]  # less is rounding of the sums
                ruled_out = w[:, :-1] <= off
                ruled_out |= w[:, :-1] >= w[:, -1:, :1] - off
                good[ruled_out] = -np.inf
            if not self.classes or self.counts or least > 1:
                count = sums[2] if self.classes and not self.counts else sums[0]
                ruled_out = count[:, :-1] < least
                ruled_out |= count[:, :-1] > count[:, -1:, :1] - least
                good[ruled_out] = -np.inf
        top, nodes = good.max(1), np.arange(len(good))
        if chosen is not None and not few:
            taken = np.zeros(top.shape, bool)
            np.put_along_axis(taken, chosen, True, 1)
            top[~taken] = -np.inf
        feature = top.argmax(1)
        gain = top[nodes, feature]
        splits = gain > 1e-9 * np.maximum(np.abs(whole + gain), np.abs(whole))
        border = good[nodes, :, feature].argmax(1)
        return chosen[nodes, feature] if few else feature, border, splits

    def _weights(self, sums: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Running sums of w and s."""
        if self.by_class is None:
            return (sums[0], sums[1]) if self.classes else (sums[2], sums[1])
        a, b = self.by_class
        ones = sums[1] if self.classes else sums[2] if a != b else None
        w = sums[0] * a if ones is None or a == b else (sums[0] - ones) * a + ones * b
        return w, sums[1] * b if self.classes else sums[1]

    def _entropies(self, count: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weight times entropy with its sign turned, gained by every border, and that of the nodes."""
        a, b = self.by_class
        rest = count - ones

        def of(zero: np.ndarray, one: np.ndarray) -> np.ndarray:
            both = self.tables[0].take(zero)
            both += self.tables[1].take(one)
            both -= self.tables[0].take(zero + one) if a == b else _xlogx(zero * a + one * b)
            return both

        whole = of(rest[:, -1:, :1], ones[:, -1:, :1])
        good = of(rest[:, :-1], ones[:, :-1])
        good += of(rest[:, -1:, :1] - rest[:, :-1], ones[:, -1:, :1] - ones[:, :-1])
        good -= whole
        return good, whole.ravel()


def _only(rows: np.ndarray, node: np.ndarray, ids: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of the nodes to keep, their nodes numbered anew."""
    if keep.all():
        return rows, node, ids
    mine = keep[node]
    return rows[mine], (np.cumsum(keep) - 1)[node[mine]], ids[keep]


def _merged(sums: np.ndarray, parents: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The node that stands for every node once sibling leaves of one class have become one leaf."""
    says, inner = sums[:, 0] > sums[:, 1] - sums[:, 0], np.zeros(len(sums), bool)
    for ids, _ in parents:
        inner[ids] = True
    stands = np.arange(len(sums))
    joined = np.zeros(len(sums), bool)
    for ids, new in reversed(parents):
        one, two = new[::2], new[1::2]
        joined[ids] = ~inner[one] & ~inner[two] & (says[one] == says[two])
        inner[ids[joined[ids]]] = False
    for ids, new in parents:
        up = np.repeat(ids, 2)
        stands[new] = np.where(joined[up], stands[up], new)
    return stands


#: Hears of every tree that a model keeps: the tree, its share in the margin, the leaves of the rows and the tree's s by row.
Keep = Callable[[Grown, float, np.ndarray, np.ndarray], None]


def _forest(
    rows: Rows, y: np.ndarray, train: np.ndarray, by_class: tuple[float, float], recipe: Recipe, rng: np.random.Generator, keep: Keep | None = None
) -> np.ndarray:
    votes, weight = np.zeros(len(y)), np.where(y > 0.5, by_class[1], by_class[0])
    for _ in range(recipe.trees):
        c = train * rng.poisson(recipe.rate, len(y)) if recipe.bootstrap else train.astype(float)
        if not c.any():
            continue
        s = c * weight * y
        leaf, tree = rows.tree(c * weight, s, c, recipe, rng, True, by_class)
        votes += (tree.sums[:, 0] / tree.sums[:, 1])[leaf] - 0.5
        if keep:
            keep(tree, 1.0, leaf, s)
    return votes > 1e-9


def _boosted(
    rows: Rows, y: np.ndarray, train: np.ndarray, by_class: tuple[float, float], recipe: Recipe, rng: np.random.Generator, held: np.ndarray,
    keep: Keep | None = None,
) -> np.ndarray:
    sign, margin, weight = 2.0 * y - 1.0, np.zeros(len(y)), np.where(y > 0.5, by_class[1], by_class[0])
    watched = train & (held < recipe.held) if recipe.held is not None else None
    grown_on = train if watched is None else train & ~watched
    best, least_error = margin, math.inf
    waiting: list[tuple] = []  # trees that are kept once a later one is the best so far
    for turn in range(recipe.trees):
        target = sign if turn == 0 else 4.0 * sign / (1.0 + np.exp(np.minimum(2.0 * sign * margin, 700.0)))
        c = (grown_on & (rng.random(len(y)) < recipe.rate)).astype(float)
        if c.any():
            share = 1.0 if turn == 0 else recipe.step
            leaf, tree = rows.tree(c * weight, c * weight * target, c, recipe, rng, False, by_class)
            margin = margin + share * (tree.sums[:, 0] / tree.sums[:, 1])[leaf]
            if keep:
                waiting.append((tree, share, leaf, c * weight * target * target))
        better = watched is None or not watched.any()
        if better:
            best = margin
        else:
            error = float(np.average(2.0 * np.logaddexp(0.0, -2.0 * (sign * margin)[watched]), weights=weight[watched]))
            if turn and least_error - error < recipe.tol * max(error, 0.01):
                break
            better = error < least_error
            if better:
                best, least_error = margin, error
        if keep and better:
            for kept in waiting:
                keep(*kept)
            waiting = []
    return best > 0


def _ada(rows: Rows, y: np.ndarray, train: np.ndarray, recipe: Recipe, rng: np.random.Generator, keep: Keep | None = None) -> np.ndarray:
    weight, c, margin = train.astype(float), train.astype(float), np.zeros(len(y))
    for _ in range(recipe.trees):
        leaf, tree = rows.tree(weight, weight * y, c, recipe, rng, True)
        s, w = tree.sums[:, 0], tree.sums[:, 1]
        says = (s > w - s)[leaf]
        miss = says != (y > 0.5)
        total = weight.sum()
        error = weight[miss].sum() / total
        if error >= 0.5:
            break
        share = 1.0 if error <= 0 else recipe.step * math.log((1 - error) / error)
        margin += share * np.where(says, 1.0, -1.0)
        if keep:
            keep(tree, share, leaf, weight)
        if error <= 0:
            break
        weight = weight * np.where(miss, math.exp(share), 1.0) / total
    return margin > 0


def predicted(rows: Rows, y: np.ndarray, train: np.ndarray, held: np.ndarray, recipe: Recipe, keep: Keep | None = None, seed: Sequence[int] = (SEED,)) -> np.ndarray:
    """Whether the fitted model says class 1, for every row; ``keep`` hears of its trees."""
    if not train.any():
        raise ValueError("no rows to train on")
    counts = np.bincount(y[train].astype(int), minlength=2)
    a, b = recipe.weights or (counts.sum() / ((counts > 0).sum() * np.maximum(counts, 1)))
    by_class, rng = (float(a), float(b)), np.random.default_rng(seed[0] if len(seed) == 1 else seed)
    if recipe.kind == "forest":
        return _forest(rows, y, train, by_class, recipe, rng, keep)
    return _boosted(rows, y, train, by_class, recipe, rng, held, keep) if recipe.kind == "boosted" else _ada(rows, y, train, recipe, rng, keep)


def _cells(says: np.ndarray, y: np.ndarray, taken: np.ndarray) -> list[int]:
    return np.bincount((2 * y[taken] + says[taken]).astype(int), minlength=4).tolist()


def _bytes(table: DataFrame, features: str) -> int:
    """Bytes of all feature values as doubles."""
    first = table.first()
    return 0 if first is None else table.count() * max(1, len(first[features])) * 8


def fits_in_tasks(table: DataFrame, features: str) -> bool:
    """Whether the rows of a fit may travel to one task."""
    return 0 < _bytes(table, features) <= FIT_BYTES


def _dealt(asked: Sequence[tuple[Recipe, int, float]], most: int) -> list[tuple[int, list[int]]]:
    """(fold, numbers of fits) of about ``most`` groups of about equal cost, the costliest first."""
    folds = sorted({fold for _, fold, _ in asked})
    groups = []
    for fold in folds:
        mine = sorted((i for i, a in enumerate(asked) if a[1] == fold), key=lambda i: -asked[i][0].cost * asked[i][2])
        hands = [[0.0, []] for _ in range(min(len(mine), -(-most // len(folds))))]
        for i in mine:
            hand = min(hands, key=lambda h: h[0])
            hand[0] += asked[i][0].cost * asked[i][2] + 1e-6
            hand[1].append(i)
        groups += [(cost, fold, fits) for cost, fits in hands]
    return [(fold, fits) for _, fold, fits in sorted(groups, key=lambda g: -g[0])]


def sent(table: DataFrame, id_col: str, label: str, features: str, fold: Column, place: Column) -> DataFrame:
    """The rows as they travel, values in four bytes where these hold them exactly."""
    x = vector_to_array(features)
    rows = table.select(
        F.col(id_col).alias("id"), F.col(label).cast("double").alias("y"), fold.cast("int").alias("fold"), place.cast("double").alias("place"),
        (F.pmod(F.xxhash64(F.lit(7), id_col), F.lit(1 << 20)) / float(1 << 20)).alias("held"), x.alias("x"),
    )
    longer = F.exists("x", lambda v: ~v.cast("float").cast("double").eqNullSafe(v))
    return rows if rows.agg(F.max(longer)).first()[0] else rows.withColumn("x", F.col("x").cast("array<float>"))


def columns_of(part: pa.Table) -> tuple[np.ndarray, ...]:
    """id order, y, fold, place and held in that order, and x as it arrived."""
    order = np.argsort(part.column("id").to_numpy(), kind="stable")
    y, folds, place, held = (part.column(c).to_numpy()[order] for c in ("y", "fold", "place", "held"))
    chunks = [c.flatten().to_numpy(zero_copy_only=False) for c in part.column("x").chunks if len(c)]
    return order, y, folds, place, held, np.concatenate(chunks).reshape(len(y), -1)


def confusions(
    table: DataFrame, id_col: str, label: str, features: str, asked: Sequence[tuple[Recipe, int, float]], run: Callable[[DataFrame, Callable, Sequence], list],
    done: Callable[[dict[int, tuple | Exception]], None] = lambda found: None,
) -> list[tuple | Exception]:
    """Per fit (recipe, fold, share): tn, fp, fn, tp on its training rows, then on its fold, or its error.

    ``table`` has ``fold`` and ``place``; rows of other folds are trained on whose place is below the share. ``run`` submits the jobs, as
    many at a time as it likes; ``done`` hears of the fits of a job by their numbers, as soon as it ends.
    """
    slots = table.sparkSession.sparkContext.defaultParallelism
    groups = _dealt(asked, slots * (GROUPS if _bytes(table, features) <= MANY_BYTES else MANY_GROUPS))
    rows = sent(table, id_col, label, features, F.col("fold"), F.col("place"))
    jobs = [range(at, min(at + JOB_GROUPS * slots, len(groups))) for at in range(0, len(groups), JOB_GROUPS * slots)]

    def job(numbers: range) -> dict[int, tuple | Exception]:
        mine = {g: (groups[g][0], [(i, asked[i][0], asked[i][2]) for i in groups[g][1]]) for g in numbers}

        def score(key: tuple, part: pa.Table) -> pa.Table:
            fold, fits = mine[key[0].as_py()]
            order, y, folds, place, held, x = columns_of(part)
            del part
            back = np.argsort(order)
            out, last = [], None
            for i, recipe, share in sorted(fits, key=lambda f: f[2]):
                train = (folds != fold) & (place < share)
                try:
                    if last is None or last[0] != (share, recipe.held):
                        grown_on = train if recipe.held is None else train & (held >= recipe.held)
                        last = None
                        last = (share, recipe.held), Rows(binned(x, grown_on[back])[order])
                    says = predicted(last[1], y, train, held, recipe)
                    out.append((i, _cells(says, y, train) + _cells(says, y, folds == fold), None))
                except Exception as error:  # one fit that fails ends neither the group nor the search
                    out.append((i, None, str(error)))
            names = ("fit", "cells", "error")
            return pa.table({n: pa.array(v, t) for n, v, t in zip(names, zip(*out), (pa.int32(), pa.list_(pa.int64()), pa.string()))})

        copies = rows.withColumn("group", F.explode(F.sequence(F.lit(numbers[0]), F.lit(numbers[-1]))))
        scored = copies.repartitionByRange(len(numbers), "group").groupBy("group").applyInArrow(score, "fit int, cells array<bigint>, error string")
        found = {r["fit"]: tuple(r["cells"]) if r["error"] is None else ValueError(r["error"]) for r in scored.collect()}
        done(found)
        return found

    every = {}
    for found in run(table, job, jobs):
        every |= found
    return [every[i] for i in range(len(asked))]


NODES = (
    "treeID int, weight double, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>, rawCount bigint, gain double, "
    "leftChild int, rightChild int, split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>"
)


def _nodes(tree: Grown, borders: list[np.ndarray], recipe: Recipe, leaf: np.ndarray, per_row: np.ndarray) -> list[dict]:
    """The nodes of a tree as Spark saves them; ``per_row`` are the rows' squares in a boosted tree."""
    reached = np.zeros(len(tree.left), bool)
    reached[0] = True
    for n in np.flatnonzero(tree.left >= 0):
        reached[tree.left[n] : tree.left[n] + 2] = reached[n]
    number = np.cumsum(reached) - 1
    s, w, c = tree.sums.T
    if recipe.kind == "boosted":
        squares = np.bincount(leaf, per_row, len(s))
        for n in np.flatnonzero((tree.left >= 0) & reached)[::-1]:
            squares[n] = squares[tree.left[n]] + squares[tree.left[n] + 1]
        stats, says, impurity = np.stack([w, s, squares], 1), s / w, np.maximum(squares / w - (s / w) ** 2, 0.0)
    else:
        stats, says, p = np.stack([w - s, s], 1), (s > w - s).astype(float), np.clip(s / w, 0.0, 1.0)
        impurity = -(_xlogx(p) + _xlogx(1 - p)) / math.log(2) if recipe.entropy else 2 * p * (1 - p)
    out = []
    for n in np.flatnonzero(reached):
        low, split, gain = int(tree.left[n]), (-1, [], -1), -1.0
        if low >= 0:
            f = int(tree.feature[n])
            split = (f, [float(borders[f][tree.border[n]])], -1)
            gain = float(impurity[n] - (w[low] * impurity[low] + w[low + 1] * impurity[low + 1]) / w[n])
        children = (int(number[low]), int(number[low + 1])) if low >= 0 else (-1, -1)
        values = (int(number[n]), float(says[n]), float(impurity[n]), stats[n].tolist(), int(c[n]), gain, *children)
        names = ("id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild")
        out.append(dict(zip(names, values)) | {"split": dict(zip(("featureIndex", "leftCategoriesOrThreshold", "numCategories"), split))})
    return out


def grown(table: DataFrame, id_col: str, label: str, features: str, recipe: Recipe) -> DataFrame:
    """The nodes of one fit on all rows, written, with the trees' weights. The trees of a forest are shared out to the slots."""
    shares = min(recipe.trees, table.sparkSession.sparkContext.defaultParallelism) if recipe.kind == "forest" else 1
    rows = sent(table, id_col, label, features, F.lit(0), F.lit(0.0))

    def grow(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = key[0].as_py()
        order, y, _, _, held, x = columns_of(pa.Table.from_batches(parts))
        train = np.ones(len(y), bool)
        grown_on = train if recipe.held is None else held >= recipe.held
        borders = borders_of(x, grown_on[np.argsort(order)])
        bins = Rows(binned(x, train, borders)[order])
        trees: list[list[dict]] = []
        weights: list[float] = []

        def keep(tree: Grown, weight: float, leaf: np.ndarray, per_row: np.ndarray) -> None:
            trees.append(_nodes(tree, borders, recipe, leaf, per_row))
            weights.append(weight)

        own = replace(recipe, trees=len(range(mine, recipe.trees, shares)))
        predicted(bins, y, train, held, own, keep, (SEED,) if shares == 1 else (SEED, mine))
        for i, (nodes, weight) in enumerate(zip(trees, weights)):
            rows = [{"treeID": mine + i * shares, "weight": weight, "nodeData": node} for node in nodes]
            yield from pa.Table.from_pylist(rows, schema).to_batches()

    schema = to_arrow_schema(_parse_datatype_string(NODES))
    copies = rows.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    return cut_lineage(copies.repartitionByRange(shares, "group").groupBy("group").applyInArrow(grow, NODES))


def as_model(nodes: DataFrame, learner: Any, kind: type, width: int) -> Any:
    """Spark's model ``kind`` of the given nodes, with the parameters of the learner, read from a folder laid out as Spark's writer does."""
    spark = nodes.sparkSession
    weights = sorted((r["treeID"], r["weight"]) for r in nodes.where("nodeData.id = 0").select("treeID", "weight").collect())
    path = fresh_path(spark)
    regression = kind is GBTClassificationModel
    member = "regression.DecisionTreeRegressionModel" if regression else "classification.DecisionTreeClassificationModel"
    given = {p.name: v for p, v in learner._paramMap.items()}
    known = {p.name: v for p, v in learner._defaultParamMap.items()}
    of_tree = ("featuresCol", "labelCol", "predictionCol", "impurity", "maxBins", "maxDepth", "minInstancesPerNode", "minInfoGain", "weightCol")

    def described(name: str, uid: str, only: Sequence[str] | None = None, **more: Any) -> str:
        sets = [{n: v for n, v in values.items() if only is None or n in only} for values in (given, known)]
        facts = {"class": f"org.apache.spark.ml.{name}", "timestamp": 0, "sparkVersion": spark.version, "uid": uid}
        return json.dumps(facts | {"paramMap": sets[0], "defaultParamMap": sets[1]} | more)

    whole = described(f"classification.{kind.__name__}", learner.uid, None, numFeatures=width, numTrees=len(weights), **({} if regression else {"numClasses": 2}))
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    trees = [(i, described(member, f"{learner.uid}_{i}", of_tree), weight) for i, (_, weight) in enumerate(weights)]
    spark.createDataFrame(trees, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    number = F.element_at(F.create_map(*[F.lit(v) for i, (tree, _) in enumerate(weights) for v in (tree, i)]), F.col("treeID"))
    nodes.select(number.alias("treeID"), "nodeData").write.parquet(f"{path}/data")
    return kind.load(path)
