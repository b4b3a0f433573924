"""Models fitted together against Spark's own fits, one by one."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tamarack.operators import linear, tuning
from tamarack.session import cut_lineage


@pytest.fixture(scope="module")
def train(spark):
    noise = [F.randn(k) * (k + 1) + 100.0 * k for k in range(5)]
    rows = spark.range(600).select(F.col("id").alias("row_id"), F.array(*noise, F.lit(3.0)).alias("_a"))
    pull = F.get("_a", F.lit(0)) * 2 - (F.get("_a", F.lit(2)) - 200) / 3 + F.randn(77)
    return rows.select("row_id", (pull > 1).cast("int").alias("label"), array_to_vector("_a").alias("features")).localCheckpoint()


LOGISTIC = [
    {"C": c, "penalty": penalty, "l1_ratio": 0.4, "class_weight": weight, "max_iter": 1000}
    for c, penalty, weight in ((1e-3, "l2", None), (10.0, "l1", "balanced"), (0.05, "l1", None), (1.0, "elasticnet", "balanced"), (1e4, "l2", "balanced"))
]
SVC = [{"C": c, "tol": 1e-5, "class_weight": w, "max_iter": 2000} for c, w in ((1e-2, None), (1.0, "balanced"))]
SGD = [{"alpha": a, "penalty": p, "l1_ratio": 0.5, "class_weight": None, "max_iter": 1000} for a, p in ((1e-2, "elasticnet"), (1e-4, "l2"))]


def _together(parted, tasks):
    with linear.Rows(parted.table.withColumn("place", F.lit(0.0)), "label", "features") as rows:
        found = linear.fit_linear(rows, [fit.trained_on(f) for fit, f in tasks])
        return [np.append(got[:-1], got[-1] - got[:-1] @ rows.shift) for got in found]


@pytest.mark.parametrize("name, drawn", [("Logistic Regression", LOGISTIC), ("SGD Classifier", SGD)])
def test_models_fitted_together_are_those_fitted_alone(spark, train, name, drawn):
    parted = tuning.Folds(train, 2, 42)
    tasks = [(tuning.BUILDERS[name](p), i % 2) for i, p in enumerate(drawn)]
    for (fit, f), got in zip(tasks, _together(parted, tasks)):
        alone = fit(parted.pairs[f][0]).model
        want = alone.coefficients.toArray()
        assert got[:-1] == pytest.approx(want, abs=2e-2 * max(1e-3, np.abs(want).max()))
        assert got[-1] == pytest.approx(alone.intercept, abs=2e-2 * max(1.0, abs(alone.intercept)))
    f1, area = tuning._linear_scores(parted, tasks[:1])[0]
    assert (f1, area) == pytest.approx(tuning.fold_scores(tasks[0][0], *parted.pairs[0]), abs=0.02)
    parted.close()


def test_margins_fitted_together_are_no_worse_than_alone(spark, train):
    """The hinge has kinks: two ways down end at slightly different points, so that the objective decides."""
    parted = tuning.Folds(train, 2, 42)
    fits = [tuning.BUILDERS["Linear SVC"](p) for p in SVC]
    rows = parted.pairs[0][0].collect()
    y, x = np.array([2.0 * r["label"] - 1 for r in rows]), np.array([r["features"].toArray() for r in rows])
    for fit, got in zip(fits, _together(parted, [(fit, 0) for fit in fits])):
        weight = np.where(y > 0, len(y) / (2 * (y > 0).sum()), len(y) / (2 * (y < 0).sum())) if fit.problem.balanced else np.ones(len(y))
        mean = weight @ x / weight.sum()
        spread = np.sqrt(weight @ (x - mean) ** 2 / (weight.sum() - weight @ weight / weight.sum()))

        def objective(coefficients, intercept):
            lost = weight @ np.maximum(0, 1 - y * (x @ coefficients + intercept)) / weight.sum()
            return lost + 0.5 / (fit.problem.strength * len(y)) * ((coefficients * spread) ** 2).sum()

        alone = fit(parted.pairs[0][0]).model
        assert objective(got[:-1], got[-1]) <= objective(alone.coefficients.toArray(), alone.intercept) * 1.001
    parted.close()


def test_a_search_reads_the_rows_for_all_fits_at_a_time(spark, train, monkeypatch, tmp_path):
    passes, added = [], linear.Rows.added
    monkeypatch.setattr(linear.Rows, "added", lambda self, *args: passes.append(1) or added(self, *args))
    monkeypatch.setattr(tuning, "fold_scores", lambda *_: pytest.fail("a fit of its own"))
    few = tuning.random_search("Logistic Regression", train, candidates=2, folds=2)
    once = len(passes)
    many = tuning.random_search("Logistic Regression", train, candidates=12, folds=2, ledger=str(tmp_path / "l"))
    assert many.scores.count() == 24 and few.scores.count() == 4 and len(passes) < once * 6
    passes.clear()
    again = tuning.random_search("Logistic Regression", train, candidates=12, folds=2, ledger=str(tmp_path / "l"))
    assert not passes and again.scores.collect() == many.scores.collect()
    cv = tuning.cross_validate("Logistic Regression", again.best_params, train, 2, ledger=str(tmp_path / "l"))
    assert not passes and sum(cv) / 2 == pytest.approx(again.best_f1)


def test_curve_of_fits_together(spark, train):
    fit = tuning.BUILDERS["Logistic Regression"](LOGISTIC[3])
    together = tuning.learning_curve(fit, train, (0.3, 1.0), folds=2).collect()
    alone = tuning.learning_curve(lambda frame: fit(frame), train, (0.3, 1.0), folds=2).collect()
    for one, other in zip(together, alone):
        assert tuple(one) == pytest.approx(tuple(other), abs=0.02)


def test_rows_of_one_class_and_no_rows(spark):
    rows = spark.createDataFrame([(i, 1 if i < 9 else 0, [float(i), 1.0]) for i in range(12)], "row_id long, label int, a array<double>")
    table = rows.select("row_id", "label", array_to_vector("a").alias("features"), (F.col("row_id") >= 9).cast("int").alias("fold"), F.lit(0.5).alias("place"))
    table = cut_lineage(table)
    fit = tuning.BUILDERS["Logistic Regression"](LOGISTIC[0])
    problems = [fit.trained_on(1), fit.trained_on(0), fit.trained_on(0, 0.1)]
    with linear.Rows(table, "label", "features") as held:
        found = linear.fit_linear(held, problems)
        cells = linear.confusions(held, problems[:2], found[:2])
    assert cells[0].tolist() == [0, 0, 0, 9, 0, 3, 0, 0] and cells[1].tolist() == [3, 0, 0, 0, 0, 0, 9, 0]
    assert isinstance(found[2], ValueError)


def test_one_search_gives_the_votes_of_every_k(spark, train):
    drawn = [
        {"n_neighbors": k, "weights": w, "metric": m, "p": p}
        for k, w, m, p in ((3, "uniform", "euclidean", 1), (7, "distance", "minkowski", 2), (4, "distance", "minkowski", 1), (9, "uniform", "manhattan", 1))
    ]
    fits = [tuning.BUILDERS["K-Nearest Neighbors"](p) for p in drawn]
    parted = tuning.Folds(train, 2, 42)
    tasks = [(fit, 0) for fit in fits]
    got = tuning._neighbour_scores(parted, tasks, None)
    for (fit, f), scores in zip(tasks, got):
        assert scores == pytest.approx(tuning.fold_scores(fit, *parted.pairs[f]))
    parted.close()


def test_neighbour_candidates_share_their_searches(spark, train, monkeypatch):
    made, build = [], tuning.nearest_neighbours
    monkeypatch.setattr(tuning, "nearest_neighbours", lambda *a, **k: made.append(1) or build(*a, **k))
    found = tuning.random_search("K-Nearest Neighbors", train, candidates=12, folds=2)
    assert found.scores.count() == 24 and len(made) <= 2 * 3 + 1
