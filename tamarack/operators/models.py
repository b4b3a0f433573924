"""The ten baseline classifiers, their scores, the leaderboard and the voting ensemble."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool
from typing import Any

import numpy as np
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tamarack.operators import metrics
from tamarack.operators.boosting import BoostedModel, fit_adaboost
from tamarack.operators.neighbours import KnnIndex, index_neighbours, search_index, vote, votes_at
from tamarack.operators.scaling import balanced
from tamarack.operators.splitting import class_counts
from tamarack.session import fresh_path
from tamarack.sources.persisted import Persisted

BOARD_COLUMNS = ["Model", "Accuracy", "Precision", "Recall", "F1-Score", "AUC-ROC", "Training Time"]
ID, LABEL, FEATURES = "row_id", "label", "features"


@dataclass
class Fitted:
    """A trained model: ``score`` maps a frame to (row_id, label, prediction, score, has_probability)."""

    name: str
    score: Callable[[DataFrame], DataFrame]
    model: Any = None
    has_probability: bool = True
    seconds: float = 0.0
    note: str = ""


def _spark_scores(model: Any, frame: DataFrame) -> DataFrame:
    """Probability of class 1 where the model gives one, else its margin scaled to 0..1."""
    out = model.transform(frame)
    if "probability" in out.columns:
        return out.select(ID, LABEL, "prediction", vector_to_array("probability")[1].alias("score"))
    margins = out.select(ID, LABEL, "prediction", vector_to_array("rawPrediction")[1].alias("_m"))
    return metrics.scaled_margin(margins, "_m", "score").drop("_m")


def _estimator(estimator: Any, weighted: bool = True) -> Callable[[DataFrame], Fitted]:
    def train(frame: DataFrame) -> Fitted:
        ready = balanced(frame, LABEL) if weighted else frame
        if weighted:
            estimator.setWeightCol("weight")
        model = estimator.setLabelCol(LABEL).setFeaturesCol(FEATURES).fit(ready)
        shows = model.hasParam("probabilityCol")
        return Fitted("", lambda f: _spark_scores(model, f), model, shows)

    return train


def logistic_regression(frame: DataFrame, c: float = 0.1, iterations: int = 1000) -> Fitted:
    """L2 penalty of strength 1/(C * rows): the balanced weights add up to the row count."""
    rows = frame.count()
    return _estimator(
        LogisticRegression(regParam=1.0 / (c * rows), elasticNetParam=0.0, standardization=False, maxIter=iterations)
    )(frame)


def sgd_classifier(frame: DataFrame, alpha: float = 1e-4, iterations: int = 1000) -> Fitted:
    """Stands in for a linear classifier by stochastic descent: Spark's logistic regression with the same L2 penalty."""
    learner = LogisticRegression(regParam=alpha, elasticNetParam=0.0, standardization=False, maxIter=iterations)
    fitted = _estimator(learner)(frame)
    fitted.note = "substitute: Spark logistic regression"
    return fitted


def random_forest(frame: DataFrame) -> Fitted:
    return _estimator(
        RandomForestClassifier(numTrees=100, maxDepth=10, minInstancesPerNode=5, seed=42)
    )(frame)


class NeighboursModel(Persisted, Model):
    """k nearest neighbours over an index on disk.

    Parts: ``cells``, the training rows by cell, ``pivots``, and ``stats`` (cell, rows, least and greatest radius).
    """

    k = Param(Params._dummy(), "k", "neighbours that vote", TypeConverters.toInt)
    weighting = Param(Params._dummy(), "weighting", "distance or uniform", TypeConverters.toString)
    metric = Param(Params._dummy(), "metric", "distance between vectors", TypeConverters.toString)
    partitioned = {"cells": ["cell"]}

    def __init__(self, parts: dict[str, Any] | None = None, **params: Any) -> None:
        super().__init__()
        self.parts = dict(parts or {})
        self._set(**params)

    def index(self) -> KnnIndex:
        stats = {int(c): (int(n), low, high) for c, n, low, high in self.parts["stats"]}
        return KnnIndex(self.parts["pivots"], stats, self.parts["cells"], self.getOrDefault("metric"), partitioned=bool(stats))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """Adds prediction and score; rows stay out when there are no training rows."""
        asked = dataset.select(ID, vector_to_array(FEATURES).alias("_a"))
        found = search_index(self.index(), asked, self.getOrDefault("k"), ID, "_a")
        votes = vote(found, ID, self.getOrDefault("weighting")).withColumnRenamed("probability", "score")
        return dataset.join(votes, ID)

    def cells_by_vote(self, dataset: DataFrame, votes: Sequence[tuple[int, str]]) -> list[tuple[int, ...]]:
        """(tn, fp, fn, tp) on labelled rows per (k, weighting), k up to the model's own, from one search."""
        asked = dataset.select(ID, vector_to_array(FEATURES).alias("_a"))
        found = search_index(self.index(), asked, self.getOrDefault("k"), ID, "_a")
        said = votes_at(found, ID, votes).join(dataset.select(ID, F.col(LABEL).cast("int").alias("_y")), ID)
        counts = [
            F.count(F.when((F.col("_y") == a) & (F.get("said", F.lit(i)) == b), 1)) for i in range(len(votes)) for a in (0, 1) for b in (0, 1)
        ]
        row = said.agg(F.array(*counts).alias("n")).first()["n"]
        return [tuple(row[i : i + 4]) for i in range(0, len(row), 4)]


def nearest_neighbours(frame: DataFrame, k: int = 5, weighting: str = "distance", metric: str = "euclidean") -> Fitted:
    """Writes the training frame by cells; scoring opens the cells that the distance bounds leave."""
    train = frame.select(F.col(ID).alias("train_id"), vector_to_array(FEATURES).alias("_a"), LABEL)
    index = index_neighbours(train, "train_id", "_a", metric, LABEL).written(fresh_path(frame.sparkSession))
    stats = np.array([(c, *numbers) for c, numbers in sorted(index.stats.items())], dtype=float).reshape(-1, 4)
    parts = {"cells": index.rows, "pivots": index.centres, "stats": stats}
    return fitted_of("", NeighboursModel(parts, k=k, weighting=weighting, metric=metric))


def fitted_of(name: str, model: Any) -> Fitted:
    """A trained or loaded model of any of the ten kinds, ready to score."""
    if isinstance(model, NeighboursModel):
        return Fitted(name, lambda f: model.transform(f).select(ID, LABEL, "prediction", "score"), model)
    if isinstance(model, BoostedModel):
        return Fitted(name, lambda f: model.transform(f).select(ID, LABEL, "prediction", F.col("probability_1").alias("score")), model)
    return Fitted(name, lambda f: _spark_scores(model, f), model, model.hasParam("probabilityCol"))


def _positive_weight(frame: DataFrame) -> DataFrame:
    counts = class_counts(frame, LABEL)
    ratio = counts.get(0, 0) / counts[1] if counts.get(1) else 1.0
    return frame.withColumn("weight", F.when(F.col(LABEL) == 1, ratio).otherwise(1.0))


def gradient_trees_weighted(frame: DataFrame) -> Fitted:
    """Stands in for XGBoost: 100 trees of depth 6, step 0.3, positives weighted n0/n1."""
    learner = GBTClassifier(
        maxIter=100, maxDepth=6, stepSize=0.3, seed=42, weightCol="weight", labelCol=LABEL, featuresCol=FEATURES
    )
    model = learner.fit(_positive_weight(frame))
    return Fitted("", lambda f: _spark_scores(model, f), model, note="Spark gradient-boosted trees")


def gradient_trees_balanced(frame: DataFrame) -> Fitted:
    """Stands in for LightGBM: 100 trees, step 0.1, at most 32 leaves, balanced classes."""
    fitted = _estimator(GBTClassifier(maxIter=100, maxDepth=5, stepSize=0.1, minInstancesPerNode=20, seed=42))(frame)
    fitted.note = "Spark gradient-boosted trees"
    return fitted


def gradient_boosting(frame: DataFrame) -> Fitted:
    return _estimator(
        GBTClassifier(maxIter=100, subsamplingRate=0.8, maxDepth=5, stepSize=0.1, seed=42), weighted=False
    )(frame)


def adaboost(frame: DataFrame, rounds: int = 100) -> Fitted:
    return fitted_of("", fit_adaboost(frame, LABEL, FEATURES, rounds))


def linear_svc(frame: DataFrame, iterations: int = 2000, retry_iterations: int = 5000) -> Fitted:
    """No probability; a failed fit is tried once more with more iterations."""
    rows = frame.count()
    for limit in (iterations, retry_iterations):
        try:
            return _estimator(LinearSVC(regParam=1.0 / rows, maxIter=limit, standardization=False))(frame)
        except Exception:
            if limit == retry_iterations:
                raise
    raise AssertionError


def decision_tree(frame: DataFrame) -> Fitted:
    return _estimator(DecisionTreeClassifier(maxDepth=10, seed=42))(frame)


TRAINERS: dict[str, Callable[[DataFrame], Fitted]] = {
    "Logistic Regression": logistic_regression,
    "SGD Classifier": sgd_classifier,
    "Random Forest": random_forest,
    "K-Nearest Neighbors": nearest_neighbours,
    "XGBoost": gradient_trees_weighted,
    "LightGBM": gradient_trees_balanced,
    "Gradient Boosting": gradient_boosting,
    "AdaBoost": adaboost,
    "Linear SVC": linear_svc,
    "Decision Tree": decision_tree,
}


def train(name: str, frame: DataFrame) -> Fitted:
    """Train one model on (row_id, label, features) and time it."""
    start = time.perf_counter()
    fitted = TRAINERS[name](frame)
    fitted.name, fitted.seconds = name, time.perf_counter() - start
    return fitted


@dataclass
class Training:
    """Trained models, and the names of those that failed with their reason."""

    fitted: list[Fitted] = field(default_factory=list)
    failed: dict[str, str] = field(default_factory=dict)

    def whole(self) -> list[Fitted]:
        """The trained models, if none failed: a vote or a leaderboard of the rest would look like the whole result."""
        if self.failed:
            raise RuntimeError("; ".join(f"{name} could not be trained: {reason}" for name, reason in self.failed.items()))
        return self.fitted


def _together(frame: DataFrame, run: Callable, tasks: Sequence) -> list:
    """Results of ``run`` in the order of the tasks, from a driver thread each: models are few, and their many short jobs leave slots free."""
    with ThreadPool(max(1, len(tasks))) as pool:
        return pool.map(inheritable_thread_target(frame.sparkSession)(run), tasks, chunksize=1)


def train_all(frame: DataFrame, names: Sequence[str] = tuple(TRAINERS)) -> Training:
    """Train every model, all at a time; one that fails is noted and the rest go on. A model's time includes its waits for the others."""
    held = frame.persist(StorageLevel.MEMORY_AND_DISK)
    held.count()  # or each model would read the rows

    def fit(name: str) -> Fitted | str:
        try:
            return train(name, held)
        except Exception as error:
            return f"{type(error).__name__}: {error}"

    found = dict(zip(names, _together(held, fit, names)))
    held.unpersist()
    failed = {name: reason for name, reason in found.items() if isinstance(reason, str)}
    return Training([fitted for fitted in found.values() if not isinstance(fitted, str)], failed)


def board_row(fitted: Fitted, test: DataFrame) -> DataFrame:
    """One leaderboard row from the model's predictions on the test frame."""
    scored = fitted.score(test).persist(StorageLevel.MEMORY_AND_DISK)
    values = metrics.binary_scores(scored, LABEL, "prediction").first()
    auc = metrics.roc_auc(scored, LABEL, "score").first()["auc"]
    scored.unpersist()
    schema = (
        "Model string, Accuracy double, Precision double, Recall double, "
        "`F1-Score` double, `AUC-ROC` double, `Training Time` double"
    )
    row = (fitted.name, values["accuracy"], values["precision"], values["recall"], values["f1"], auc, fitted.seconds)
    return test.sparkSession.createDataFrame([row], schema)


def leaderboard(models: Sequence[Fitted], test: DataFrame) -> DataFrame:
    held = test.persist(StorageLevel.MEMORY_AND_DISK)
    held.count()
    board = None
    for row in _together(held, lambda fitted: board_row(fitted, held), models):
        board = row if board is None else board.unionByName(row)
    held.unpersist()
    return board


def best_models(board: DataFrame, count: int) -> DataFrame:
    return board.orderBy(F.desc("F1-Score"), "Model").limit(count)


def combine_boards(boards: dict[str, DataFrame]) -> DataFrame:
    """All variants under each other, with a ``Data Type`` column."""
    out = None
    for variant, board in boards.items():
        tagged = board.withColumn("Data Type", F.lit(variant))
        out = tagged if out is None else out.unionByName(tagged)
    return out


def best_per_variant(combined: DataFrame) -> DataFrame:
    first = W.partitionBy("Data Type").orderBy(F.desc("F1-Score"), "Model")
    return combined.withColumn("_r", F.row_number().over(first)).where("_r = 1").drop("_r")


def soft_vote(members: Sequence[DataFrame], id_col: str = ID, label: str = LABEL) -> DataFrame:
    """Mean score of the members per row; 1 above one half. Members share ids and labels."""
    stacked = members[0].select(id_col, label, "score")
    for member in members[1:]:
        stacked = stacked.unionByName(member.select(id_col, label, "score"))
    return (
        stacked.groupBy(id_col)
        .agg(F.max(label).alias(label), F.avg("score").alias("score"))
        .withColumn("prediction", (F.col("score") > 0.5).cast("double"))
    )


def best_members(models: Sequence[Fitted], board: DataFrame, count: int = 3) -> list[Fitted]:
    """The best models by F1 among those that give probabilities."""
    able = {m.name: m for m in models if m.has_probability}
    return [able[r["Model"]] for r in best_models(board.where(F.col("Model").isin(list(able))), count).collect()]


def vote_of_best(models: Sequence[Fitted], board: DataFrame, test: DataFrame, count: int = 3) -> DataFrame:
    """Soft vote of the best models by F1 among those that give probabilities."""
    return soft_vote([m.score(test) for m in best_members(models, board, count)])
