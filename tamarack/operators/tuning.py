"""Random hyper-parameter search, cross-validation scores and learning curves.

With a ledger, every score of a fit is a written row, named by model, parameters, folds, seed and the digest of the training rows. A search
that was cut short goes on from it, and whatever asks for an equal fit later reads the row.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from multiprocessing.pool import ThreadPool
from threading import Lock
from typing import Any

import numpy as np
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.ml.functions import vector_to_array
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack.operators import linear, metrics, trees
from tamarack.operators.boosting import BoostedModel, fit_adaboost
from tamarack.operators.models import FEATURES, ID, LABEL, Fitted, _estimator, fitted_of, nearest_neighbours
from tamarack.operators.neighbours import curve_cells
from tamarack.operators.spaces import DEEPEST, sample_space
from tamarack.operators.splitting import with_folds
from tamarack.session import cut_lineage, partitions_by_bytes

#: Fits that the driver watches at a time at most.
MOST_FITS = 64


def _subset(name: str | None) -> str:
    return {"sqrt": "sqrt", "log2": "log2"}.get(name, "all")


def _depth(p: dict) -> int:
    """Spark trees end at ``DEEPEST``; deeper draws, and none, mean that depth."""
    return min(p["max_depth"] or DEEPEST, DEEPEST)


def effective(p: dict) -> dict:
    """The drawn parameters as Spark uses them."""
    return p | {"max_depth": _depth(p)} if "max_depth" in p else p


@dataclass(frozen=True)
class Trees:
    """A model of trees: fitted alone by Spark, or inside tasks to the same rules; many together by :func:`trees.confusions`.

    A frame that fits in a task is fitted there: ``model`` makes Spark's model, or boosted ones, of the nodes and the number of features.
    """

    alone: Callable[[DataFrame], Fitted]
    recipe: Callable[[], trees.Recipe]
    model: Callable[[DataFrame, int], Any]

    def __call__(self, frame: DataFrame) -> Fitted:
        if not trees.fits_in_tasks(frame, FEATURES):
            return self.alone(frame)
        return fitted_of("", self.model(trees.grown(frame, ID, LABEL, FEATURES, self.recipe()), len(frame.first()[FEATURES])))


def _forest(p: dict) -> Trees:
    rate, weighted = p["max_samples"] if p["bootstrap"] else 1.0, p["class_weight"] is not None
    learner = RandomForestClassifier(
        numTrees=p["n_estimators"],
        maxDepth=_depth(p),
        minInstancesPerNode=p["min_samples_leaf"],
        featureSubsetStrategy=_subset(p["max_features"]),
        bootstrap=p["bootstrap"],
        impurity=p["criterion"],
        subsamplingRate=rate,
        seed=42,
    )
    return Trees(
        _estimator(learner, weighted=weighted),
        lambda: trees.Recipe(
            "forest", p["n_estimators"], _depth(p), p["min_samples_leaf"], _subset(p["max_features"]), None if weighted else (1.0, 1.0),
            p["criterion"] == "entropy", p["bootstrap"], rate,
        ),
        lambda nodes, width: trees.as_model(nodes, learner, RandomForestClassificationModel, width),
    )


def _boosted(p: dict, least: int, weighted: bool, positive: float = 1.0) -> Trees:
    """``positive`` weighs the rows of class 1. A share of columns, and early stopping on a part of the rows, carry over."""
    share = p.get("colsample_bytree")
    learner = GBTClassifier(
        maxIter=p["n_estimators"],
        stepSize=p["learning_rate"],
        maxDepth=_depth(p),
        minInstancesPerNode=least,
        subsamplingRate=p["subsample"],
        featureSubsetStrategy=f"{share:.6f}" if share is not None else _subset(p.get("max_features")),
        seed=42,
    )
    held = p.get("validation_fraction")
    if held is not None:
        learner = learner.setValidationIndicatorCol("_held").setParams(validationTol=p["tol"])

    def fit(frame: DataFrame) -> Fitted:
        if held is not None:
            place = F.pmod(F.xxhash64(F.lit(7), ID), F.lit(1 << 20)) / float(1 << 20)
            frame = frame.withColumn("_held", place < held)
        if positive == 1.0:
            return _estimator(learner, weighted)(frame)
        ready = frame.withColumn("weight", F.when(F.col(LABEL) == 1, float(positive)).otherwise(1.0))
        return _estimator(learner.setWeightCol("weight"), weighted=False)(ready)

    return Trees(
        fit,
        lambda: trees.Recipe(
            "boosted", p["n_estimators"], _depth(p), least, share if share is not None else _subset(p.get("max_features")),
            None if weighted else (1.0, float(positive)), rate=p["subsample"], step=p["learning_rate"], held=held, tol=p.get("tol", 0.01),
        ),
        lambda nodes, width: trees.as_model(nodes, learner, GBTClassificationModel, width),
    )


@dataclass(frozen=True)
class Linear:
    """A linear model: fitted alone by Spark, or together with others by :func:`linear.fit_linear`, to the same objective."""

    learner: Callable[[int], Any]
    problem: linear.Problem

    def __call__(self, frame: DataFrame) -> Fitted:
        return _estimator(self.learner(frame.count()), self.problem.balanced)(frame)

    def trained_on(self, fold: int, share: float = 2.0) -> linear.Problem:
        return replace(self.problem, fold=fold, share=share)


def _logistic(p: dict) -> Linear:
    mix = {"l1": 1.0, "l2": 0.0}.get(p["penalty"], p["l1_ratio"])

    def learner(rows: int) -> LogisticRegression:
        return LogisticRegression(regParam=1.0 / (p["C"] * rows), elasticNetParam=mix, standardization=False, maxIter=p["max_iter"])

    return Linear(learner, linear.Problem(False, p["C"], mix, p["class_weight"] is not None, 1e-6, p["max_iter"], 0))


def _svc(p: dict) -> Linear:
    """Spark's linear SVC knows the hinge loss with an L2 penalty; C, tol and weights carry over."""

    def learner(rows: int) -> LinearSVC:
        return LinearSVC(regParam=1.0 / (p["C"] * rows), tol=p["tol"], maxIter=p["max_iter"])

    return Linear(learner, linear.Problem(True, p["C"], 0.0, p["class_weight"] is not None, p["tol"], p["max_iter"], 0))


def _linear(p: dict) -> Linear:
    """Substitute: Spark's logistic regression with the drawn penalty and strength."""
    mix = {"l1": 1.0, "l2": 0.0}.get(p["penalty"], p["l1_ratio"])

    def learner(rows: int) -> LogisticRegression:
        return LogisticRegression(regParam=p["alpha"], elasticNetParam=mix, standardization=False, maxIter=p["max_iter"])

    return Linear(learner, linear.Problem(False, p["alpha"], mix, p["class_weight"] is not None, 1e-6, p["max_iter"], 0, per_row=False))


@dataclass(frozen=True)
class Neighbours:
    """k nearest neighbours; candidates of one metric share the search for the largest k."""

    k: int
    weighting: str
    metric: str

    def __call__(self, frame: DataFrame) -> Fitted:
        return nearest_neighbours(frame, self.k, self.weighting, self.metric)


def _neighbours(p: dict) -> Neighbours:
    metric = p["metric"]
    if metric == "minkowski":
        metric = "manhattan" if p["p"] == 1 else "euclidean"
    return Neighbours(p["n_neighbors"], p["weights"], metric)


def _boost(p: dict) -> Trees:
    def fit(frame: DataFrame) -> Fitted:
        model = fit_adaboost(frame, LABEL, FEATURES, p["n_estimators"], p["learning_rate"], p["base_depth"])
        return Fitted(
            "", lambda f: model.transform(f).select(ID, LABEL, "prediction", F.col("probability_1").alias("score")), model
        )

    def model(nodes: DataFrame, width: int) -> BoostedModel:
        members = trees.as_model(nodes.withColumn("weight", F.lit(1.0)), RandomForestClassifier(maxDepth=p["base_depth"]), RandomForestClassificationModel, width)
        weights = nodes.where("nodeData.id = 0").orderBy("treeID").select("weight").collect()
        return BoostedModel(members.trees, [r["weight"] for r in weights])

    return Trees(fit, lambda: trees.Recipe("ada", p["n_estimators"], p["base_depth"], step=p["learning_rate"]), model)


def _tree(p: dict) -> Trees:
    """A forest of one tree on all rows, which knows the feature subset per split."""
    weighted = p["class_weight"] is not None
    learner = RandomForestClassifier(
        numTrees=1,
        bootstrap=False,
        subsamplingRate=1.0,
        featureSubsetStrategy=_subset(p["max_features"]),
        maxDepth=_depth(p),
        minInstancesPerNode=p["min_samples_leaf"],
        impurity=p["criterion"],
        seed=42,
    )
    return Trees(
        _estimator(learner, weighted=weighted),
        lambda: trees.Recipe(
            "forest", 1, _depth(p), p["min_samples_leaf"], _subset(p["max_features"]), None if weighted else (1.0, 1.0), p["criterion"] == "entropy"
        ),
        lambda nodes, width: trees.as_model(nodes, learner, RandomForestClassificationModel, width),
    )


BUILDERS: dict[str, Callable[[dict], Callable[[DataFrame], Fitted]]] = {
    "Logistic Regression": _logistic,
    "SGD Classifier": _linear,
    "Random Forest": _forest,
    "K-Nearest Neighbors": _neighbours,
    "XGBoost": lambda p: _boosted(p, p["min_child_weight"], False, p["scale_pos_weight"]),
    "LightGBM": lambda p: _boosted(p, p["min_child_samples"], p["class_weight"] is not None),
    "Gradient Boosting": lambda p: _boosted(p, p["min_samples_leaf"], False),
    "AdaBoost": _boost,
    "Linear SVC": _svc,
    "Decision Tree": _tree,
}


def fold_scores(fit: Callable[[DataFrame], Fitted], train: DataFrame, held_out: DataFrame) -> tuple[float, float]:
    """F1 and the AUC of hard labels (which equals balanced accuracy) on one held-out fold."""
    row = metrics.binary_scores(fit(train).score(held_out), LABEL, "prediction").first()
    return row["f1"], row["balanced_accuracy"]


class Folds:
    """Training and held-out rows of every fold, from one written table; small tables are few partitions."""

    def __init__(self, train: DataFrame, folds: int, seed: int) -> None:
        table = cut_lineage(with_folds(train.select(ID, LABEL, FEATURES), LABEL, ID, folds, seed))
        self.parts, self.table, self.folds = partitions_by_bytes(table), table, folds
        self.pairs = [
            tuple(table.where(w).drop("fold").coalesce(self.parts).persist(StorageLevel.MEMORY_AND_DISK) for w in (F.col("fold") != f, F.col("fold") == f))
            for f in range(folds)
        ]
        self.whole = table.drop("fold").coalesce(self.parts)

    def close(self) -> None:
        for pair in self.pairs:
            for frame in pair:
                frame.unpersist()


def _in_parallel(frame: DataFrame, run: Callable, tasks: Sequence, parallel: int | None, parts: int = 1) -> list:
    """Submit several Spark jobs at a time from driver threads: as many as fill the cluster's slots, unless ``parallel`` says otherwise."""
    slots = frame.sparkSession.sparkContext.defaultParallelism
    pool = ThreadPool(parallel or max(1, min(MOST_FITS, slots // parts)))
    try:
        return pool.map(inheritable_thread_target(frame.sparkSession)(run), tasks, chunksize=1)
    finally:
        pool.close()


def data_digest(train: DataFrame) -> str:
    """Names the training rows, whatever their order and partitions."""
    row = F.xxhash64(ID, LABEL, vector_to_array(FEATURES))
    other = F.xxhash64(F.lit(1), ID, LABEL, vector_to_array(FEATURES))
    n, one, two = train.agg(F.count(F.lit(1)), F.sum(row.cast("decimal(38,0)")), F.sum(other.cast("decimal(38,0)"))).first()
    return hashlib.sha256(f"{n}:{one}:{two}".encode()).hexdigest()


class LostLedger(Exception):
    """A score could not be written: the search ends rather than go on without its record."""


class Ledger:
    """Scores of fits as rows in a folder that outlives the driver, written as soon as a fit ends.

    Each row has a folder of its own, partitioned by the digest of the data and the fit's name, so that fits that end at the same time
    do not meet.
    """

    SCHEMA = "f1 double, roc_auc double"

    def __init__(self, spark: SparkSession, folder: str | None, train: DataFrame) -> None:
        self.spark, self.folder, self.known, self.writing = spark, folder, {}, Lock()
        if folder is None:
            return
        self.folder = f"{folder.rstrip('/')}/data={data_digest(train)}"
        try:
            rows = spark.read.schema(f"{self.SCHEMA}, fit string").json(self.folder).collect()  # one per fit on these rows
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = []
        self.known = {r["fit"]: (r["f1"], r["roc_auc"]) for r in rows}

    @staticmethod
    def name(model: str, params: dict, folds: int, seed: int, fold: int) -> str:
        return hashlib.sha256(json.dumps([model, sorted((k, str(v)) for k, v in params.items()), folds, seed, fold]).encode()).hexdigest()

    def scores(self, name: str, compute: Callable[[], tuple[float, float]]) -> tuple[float, float]:
        """The row of that name, or what ``compute`` gives, which becomes the row. Errors are not noted: such a fit is tried again."""
        if name in self.known:
            return self.known[name]
        found = compute()
        if self.folder is not None:
            try:
                self.note(name, found)
            except Exception as error:
                raise LostLedger(self.folder) from error
        self.known[name] = found
        return found

    def note_all(self, found: dict[str, tuple[float, float]]) -> None:
        """The rows of many fits that ended together, each in its own folder as :meth:`note` has them."""
        self.known |= found
        if self.folder is None or not found:
            return
        try:
            rows = self.spark.createDataFrame([(*scores, name) for name, scores in found.items()], f"{self.SCHEMA}, fit string")
            with self.writing:  # appends to one folder would clear each other's unfinished files
                rows.coalesce(1).write.mode("append").partitionBy("fit").json(self.folder)
        except Exception as error:
            raise LostLedger(self.folder) from error

    def note(self, name: str, found: tuple[float, float]) -> None:
        self.spark.createDataFrame([found], self.SCHEMA).coalesce(1).write.mode("overwrite").json(f"{self.folder}/fit={name}")


def _linear_scores(parted: Folds, tasks: list[tuple[Linear, int]]) -> list[tuple[float, float] | Exception]:
    """Scores of linear models on their held-out folds: all are fitted together."""
    problems = [fit.trained_on(fold) for fit, fold in tasks]
    with linear.Rows(parted.table.withColumn("place", F.lit(0.0)), LABEL, FEATURES) as rows:
        found = linear.fit_linear(rows, problems)
        good = [i for i, f in enumerate(found) if not isinstance(f, Exception)]
        cells = linear.confusions(rows, [problems[i] for i in good], [found[i] for i in good]) if good else []
    for i, row in zip(good, cells):
        found[i] = linear.scores_of(row[4:])
    return found


def _neighbour_scores(parted: Folds, tasks: list[tuple[Neighbours, int]], parallel: int | None) -> list[tuple[float, float] | Exception]:
    """Scores of k nearest neighbours: one search per fold and metric, for the largest k, holds the neighbours of every smaller k."""
    searches = sorted({(fold, fit.metric) for fit, fold in tasks})

    def search(asked: tuple[int, str]) -> dict[tuple[Neighbours, int], tuple[float, float] | Exception]:
        fold, metric = asked
        fits = sorted({fit for fit, f in tasks if (f, fit.metric) == asked}, key=lambda fit: (fit.k, fit.weighting))
        train, held_out = parted.pairs[fold]
        try:
            model = nearest_neighbours(train, fits[-1].k, metric=metric).model
            cells = model.cells_by_vote(held_out, [(fit.k, fit.weighting) for fit in fits])
        except Exception as error:
            return {(fit, fold): error for fit in fits}
        return {(fit, fold): linear.scores_of(row) for fit, row in zip(fits, cells)}

    found = {}
    for part in _in_parallel(parted.table, search, searches, parallel, parted.parts):
        found |= part
    return [found[task] for task in tasks]


def _tree_cells(
    table: DataFrame, asked: list[tuple[Trees, int, float]], parallel: int | None, done: Callable[[dict], None] = lambda found: None
) -> list[tuple | Exception]:
    """Counts of (tn, fp, fn, tp) on training rows and held-out fold per (model, fold, share), grown many at a time inside the tasks."""
    out: list = []
    for fit, fold, share in asked:
        try:
            out.append((fit.recipe(), fold, share))
        except Exception as error:
            out.append(error)
    good = [i for i, one in enumerate(out) if not isinstance(one, Exception)]

    def submit(frame: DataFrame, job: Callable, jobs: Sequence) -> list:
        return _in_parallel(frame, job, jobs, parallel, max(1, frame.sparkSession.sparkContext.defaultParallelism // 4))

    found = trees.confusions(
        table, ID, LABEL, FEATURES, [out[i] for i in good], submit, lambda part: done({good[i]: cells for i, cells in part.items()})
    )
    for i, cells in zip(good, found):
        out[i] = cells
    return out


def _scores(
    name: str, drawn: Sequence[dict], tasks: Sequence[tuple[int, int]], parted: Folds, noted: Ledger, seed: int, parallel: int | None
) -> list[tuple[int, int, float | None, float | None, str | None]]:
    """(candidate, fold, F1, AUC of hard labels, error) per task; linear models, neighbours and trees are scored together, others one by one.

    Trees over more rows than a task may hold are fitted by Spark, one by one.
    """
    titles = {(c, f): Ledger.name(name, drawn[c], parted.folds, seed, f) for c, f in tasks}

    def failed(error: Exception) -> str:
        return str(error).split("\n")[0][:500]

    def score(task: tuple[int, int]) -> tuple:
        c, f = task
        try:
            return (c, f, *noted.scores(titles[task], lambda: fold_scores(BUILDERS[name](drawn[c]), *parted.pairs[f])), None)
        except LostLedger:
            raise
        except Exception as error:  # a candidate that cannot be fitted is noted and loses; the search goes on
            return (c, f, None, None, failed(error))

    fits, together, errors = {}, None, {}
    for c in sorted({c for c, _ in tasks}):
        try:
            fits[c] = BUILDERS[name](drawn[c])
        except Exception as error:
            errors |= {task: failed(error) for task in tasks if task[0] == c}
    if fits and all(isinstance(fit, Linear) for fit in fits.values()):
        together = _linear_scores
    elif fits and all(isinstance(fit, Neighbours) for fit in fits.values()):
        together = lambda parted, asked: _neighbour_scores(parted, asked, parallel)
    elif fits and all(isinstance(fit, Trees) for fit in fits.values()) and trees.fits_in_tasks(parted.table, FEATURES):

        def together(parted: Folds, asked: list[tuple[Trees, int]]) -> list[tuple[float, float] | Exception]:
            def note(part: dict) -> None:
                noted.note_all({titles[left[i]]: linear.scores_of(c[4:]) for i, c in part.items() if not isinstance(c, Exception)})

            cells = _tree_cells(parted.table.withColumn("place", F.lit(0.0)), [(fit, fold, 2.0) for fit, fold in asked], parallel, note)
            return [c if isinstance(c, Exception) else linear.scores_of(c[4:]) for c in cells]

    if together is None:
        return _in_parallel(parted.table, score, tasks, parallel, parted.parts)
    left = [task for task in tasks if task not in errors and titles[task] not in noted.known]
    found = together(parted, [(fits[c], f) for c, f in left]) if left else []
    errors |= {task: failed(scores) for task, scores in zip(left, found) if isinstance(scores, Exception)}
    noted.note_all({titles[task]: scores for task, scores in zip(left, found) if task not in errors and titles[task] not in noted.known})
    return [(*task, None, None, errors[task]) if task in errors else (*task, *noted.known[titles[task]], None) for task in tasks]


@dataclass
class SearchResult:
    """Every candidate's fold scores, the best parameters and the refitted model."""

    name: str
    scores: DataFrame
    best_params: dict
    best_f1: float
    best: Fitted


def random_search(
    name: str, train: DataFrame, candidates: int = 100, folds: int = 5, parallel: int | None = None, seed: int = 42,
    space: dict[str, tuple] | None = None, ledger: str | None = None,
) -> SearchResult:
    """Draw candidates, cross-validate each, refit the best by mean F1 on the whole frame.

    ``ledger`` is a folder for the scores; scores that stand there are not computed again.
    """
    drawn = sample_space(name, candidates, seed, space)
    noted = Ledger(train.sparkSession, ledger, train)
    parted = Folds(train, folds, seed)
    tasks = [(c, f) for c in range(candidates) for f in range(folds)]

    try:
        rows = _scores(name, drawn, tasks, parted, noted, seed, parallel)
        if all(r[4] for r in rows):
            raise RuntimeError(f"no candidate of {name} could be fitted: {rows[0][4]}")
        whole = {c for c in range(candidates) if not any(r[4] for r in rows if r[0] == c)}
        f1 = [float(np.mean([r[2] for r in rows if r[0] == c])) if c in whole else -1.0 for c in range(candidates)]
        winner = int(np.argmax(f1))
        best = BUILDERS[name](drawn[winner])(parted.whole)
        best.name = name
    finally:
        parted.close()
    table = train.sparkSession.createDataFrame(
        [(c, str(effective(drawn[c])), f, a, b, e) for c, f, a, b, e in rows],
        "candidate int, params string, fold int, f1 double, roc_auc double, error string",
    )
    return SearchResult(name, table, drawn[winner], f1[winner], best)


def cross_validate(
    name: str, params: dict, train: DataFrame, folds: int = 5, parallel: int | None = None, seed: int = 42, ledger: str | None = None
) -> list[float]:
    """F1 of every fold; folds that a search with the same seed has scored are read from its ledger."""
    noted = Ledger(train.sparkSession, ledger, train)
    parted = Folds(train, folds, seed)

    try:
        rows = _scores(name, [params], [(0, f) for f in range(folds)], parted, noted, seed, parallel)
    finally:
        parted.close()
    for *_, error in rows:
        if error:
            raise RuntimeError(f"{name} could not be fitted: {error}")
    return [r[2] for r in rows]


def evaluate_tuned(
    name: str, params: dict, train: DataFrame, test: DataFrame, data_type: str, folds: int = 5, fitted: Fitted | None = None,
    ledger: str | None = None,
) -> dict:
    """Cross-validated F1 mean and population std, test F1 and test AUC (None without probabilities)."""
    fit = BUILDERS[name](params)
    cv = cross_validate(name, params, train, folds, ledger=ledger)
    fitted = fitted or fit(train.select(ID, LABEL, FEATURES))
    scored = fitted.score(test.select(ID, LABEL, FEATURES))
    auc = metrics.roc_auc(scored, LABEL, "score").first()["auc"] if fitted.has_probability else None
    return {
        "model_name": name,
        "data_type": data_type,
        "best_params": params,
        "cv_f1_mean": float(np.mean(cv)),
        "cv_f1_std": float(np.std(cv)),
        "test_f1": metrics.binary_scores(scored, LABEL, "prediction").first()["f1"],
        "test_roc_auc": auc,
    }


def _linear_curve(fit: Linear, table: DataFrame, tasks: Sequence[tuple[float, int]]) -> list[tuple[float, float, float]]:
    """(share, F1 on the training rows, F1 on the held-out fold) of a linear model, all fits together."""
    problems = [fit.trained_on(fold, share) for share, fold in tasks]
    with linear.Rows(table, LABEL, FEATURES) as rows:
        found = linear.fit_linear(rows, problems)
        for one in found:
            if isinstance(one, Exception):
                raise one
        cells = linear.confusions(rows, problems, found)
    return [(share, linear.scores_of(row[:4])[0], linear.scores_of(row[4:])[0]) for (share, _), row in zip(tasks, cells)]


def _tree_curve(fit: Trees, table: DataFrame, tasks: Sequence[tuple[float, int]], parallel: int | None) -> list[tuple[float, float, float]]:
    """As :func:`_linear_curve`, of a model of trees."""
    found = _tree_cells(table, [(fit, fold, share) for share, fold in tasks], parallel)
    for one in found:
        if isinstance(one, Exception):
            raise one
    return [(share, linear.scores_of(row[:4])[0], linear.scores_of(row[4:])[0]) for (share, _), row in zip(tasks, found)]


def learning_curve(
    fit: Callable[[DataFrame], Fitted],
    train: DataFrame,
    shares: Sequence[float] = tuple(np.linspace(0.1, 1.0, 10)),
    folds: int = 5,
    parallel: int | None = None,
    seed: int = 42,
) -> DataFrame:
    """Training and validation F1, mean and population std over folds, per share of the training rows.

    A larger share contains every row of a smaller one: rows enter by the size of their hash.
    """
    folded = cut_lineage(with_folds(train.select(ID, LABEL, FEATURES), LABEL, ID, folds, seed))
    parts = partitions_by_bytes(folded)
    place = F.pmod(F.xxhash64(F.lit(seed + 1), ID), F.lit(1 << 20)) / float(1 << 20)
    held = folded.withColumn("_place", place).coalesce(parts).persist(StorageLevel.MEMORY_AND_DISK)

    def score(task: tuple[float, int]) -> tuple[float, float, float]:
        share, fold = task
        part = held.where((F.col("fold") != fold) & (F.col("_place") < share)).select(ID, LABEL, FEATURES)
        valid = held.where(F.col("fold") == fold).select(ID, LABEL, FEATURES)
        fitted = fit(part)
        seen, fresh = (
            metrics.binary_scores(fitted.score(rows), LABEL, "prediction").first()["f1"] for rows in (part, valid)
        )
        return share, seen, fresh

    tasks = [(float(s), f) for s in shares for f in range(folds)]
    if isinstance(fit, Linear):
        rows = _linear_curve(fit, folded.withColumn("place", place), tasks)
    elif isinstance(fit, Neighbours) and trees.fits_in_tasks(folded, FEATURES):
        cells = curve_cells(folded.withColumn("place", place), ID, LABEL, FEATURES, fit.k, fit.weighting, fit.metric, tasks)
        rows = [(share, linear.scores_of(row[:4])[0], linear.scores_of(row[4:])[0]) for (share, _), row in zip(tasks, cells)]
    elif isinstance(fit, Trees) and trees.fits_in_tasks(folded, FEATURES):
        rows = _tree_curve(fit, folded.withColumn("place", place), tasks, parallel)
    else:
        rows = _in_parallel(train, score, tasks, parallel, parts)
    counts = held.agg(
        *[F.count(F.when(F.col("_place") < float(s), 1)).alias(f"c{i}") for i, s in enumerate(shares)]
    ).first()
    held.unpersist()
    table = []
    for i, share in enumerate(shares):
        seen = [r[1] for r in rows if r[0] == float(share)]
        fresh = [r[2] for r in rows if r[0] == float(share)]
        stats = (np.mean(seen), np.std(seen), np.mean(fresh), np.std(fresh))
        table.append((float(share), counts[i] * (folds - 1) / folds, *map(float, stats)))
    return train.sparkSession.createDataFrame(
        table,
        "share double, train_rows double, train_f1_mean double, train_f1_std double, "
        "valid_f1_mean double, valid_f1_std double",
    )
