"""Trees of many fits, grown inside the tasks, against Spark's trees of single fits."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array

from tamarack.operators import metrics, trees, tuning
from tamarack.session import cut_lineage

TREE = {"max_depth": 4, "min_samples_leaf": 3, "max_features": None, "class_weight": None, "criterion": "gini"}
BOOST = {"n_estimators": 8, "learning_rate": 0.3, "max_depth": 3, "subsample": 1.0}


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(3)
    rows = [(i, int(i % 3 == 0), (rng.normal(size=5) + (0.8 if i % 3 == 0 else 0)).tolist()) for i in range(500)]
    frame = spark.createDataFrame(rows, "row_id bigint, label int, x array<double>")
    return cut_lineage(frame.select("row_id", "label", array_to_vector("x").alias("features")))


@pytest.mark.parametrize(
    "name, params",
    [
        ("Decision Tree", TREE),
        ("Decision Tree", TREE | {"criterion": "entropy", "class_weight": "balanced", "max_depth": 7}),
        ("Random Forest", TREE | {"n_estimators": 40, "bootstrap": True, "max_samples": 0.8, "max_features": "sqrt"}),
        ("AdaBoost", {"n_estimators": 12, "learning_rate": 0.8, "base_depth": 2}),
        ("XGBoost", BOOST | {"colsample_bytree": 1.0, "min_child_weight": 2, "scale_pos_weight": 5}),
        ("LightGBM", BOOST | {"colsample_bytree": 1.0, "min_child_samples": 10, "class_weight": "balanced"}),
        ("Gradient Boosting", BOOST | {"max_features": None, "min_samples_leaf": 2, "validation_fraction": 0.2, "tol": 1e-4}),
    ],
)
def test_scores_are_those_of_sparks_trees(spark, blobs, name, params):
    fit = tuning.BUILDERS[name](params)
    parted = tuning.Folds(blobs, 3, 42)
    want = [tuning.fold_scores(fit, *parted.pairs[f]) for f in range(3)]
    got = tuning.random_search(name, blobs, 1, 3, space={k: ("choice", v) for k, v in params.items()}).scores.orderBy("fold").collect()
    parted.close()
    assert [r["error"] for r in got] == [None] * 3
    plain = name == "Gradient Boosting" or params == TREE
    near = 0.01 if plain else 0.05  # bags are drawn otherwise, and Spark's borders follow the weights of the rows
    assert np.mean([r["f1"] for r in got]) == pytest.approx(np.mean([f1 for f1, _ in want]), abs=near)
    assert np.mean([r["roc_auc"] for r in got]) == pytest.approx(np.mean([auc for _, auc in want]), abs=near)


@pytest.mark.parametrize("name", ["Random Forest", "Decision Tree", "XGBoost", "LightGBM", "Gradient Boosting", "AdaBoost"])
def test_a_search_fits_only_its_winner_by_spark(spark, blobs, monkeypatch, tmp_path, name):
    alone, call = [], tuning.Trees.__call__
    monkeypatch.setattr(tuning.Trees, "__call__", lambda self, frame: alone.append(self) or call(self, frame))
    monkeypatch.setattr(tuning, "sample_space", lambda *a: [_small(d) for d in _spaces(*a)])
    found = tuning.random_search(name, blobs, 3, 2, ledger=str(tmp_path))
    assert found.scores.where("error IS NULL AND f1 IS NOT NULL").count() == 6 and len(alone) == 1
    assert spark.read.json(str(tmp_path)).count() == 6
    again = tuning.random_search(name, blobs, 3, 2, ledger=str(tmp_path))
    assert again.scores.collect() == found.scores.collect() and again.best_params == found.best_params
    curve = tuning.learning_curve(tuning.BUILDERS[name](found.best_params), blobs, shares=(0.5, 1.0), folds=2).collect()
    assert len(alone) == 2 and [r["share"] for r in curve] == [0.5, 1.0] and curve[1]["train_rows"] == 250


_spaces = tuning.sample_space


def _small(drawn):
    return drawn | {"n_estimators": 4} if "n_estimators" in drawn else drawn


def test_larger_tables_are_left_to_spark(spark, blobs, monkeypatch):
    alone, call = [], tuning.Trees.__call__
    monkeypatch.setattr(tuning.Trees, "__call__", lambda self, frame: alone.append(self) or call(self, frame))
    monkeypatch.setattr(trees, "FIT_BYTES", 1000)
    assert tuning.random_search("Decision Tree", blobs, 1, 2).scores.where("error IS NULL").count() == 2 and len(alone) == 3


def test_leaves_of_one_class_merge_and_blocks_change_nothing(monkeypatch):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 4))
    y = (x[:, 0] + 0.5 * rng.normal(size=300) > 0).astype(float)
    rows, train, held = trees.Rows(trees.binned(x, np.ones(300, bool))), np.ones(300, bool), np.zeros(300)
    recipe = trees.Recipe("forest", 3, 9, 2, bootstrap=True)
    want = trees.predicted(rows, y, train, held, recipe)
    leaf, s, w = rows.grow(np.ones(300), y, np.ones(300), recipe, rng, True)
    assert (np.bincount(leaf, y, len(s)) == np.where(np.bincount(leaf, minlength=len(s)) > 0, s, 0)).all()
    monkeypatch.setattr(trees, "BLOCK_VALUES", 2 * 4 * trees.BINS)
    assert (trees.predicted(rows, y, train, held, recipe) == want).all()


@pytest.mark.parametrize(
    "name, params",
    [
        ("Decision Tree", TREE),
        ("Random Forest", TREE | {"n_estimators": 40, "bootstrap": True, "max_samples": 0.8, "max_features": "sqrt", "criterion": "entropy"}),
        ("AdaBoost", {"n_estimators": 12, "learning_rate": 0.8, "base_depth": 2}),
        ("XGBoost", BOOST | {"colsample_bytree": 1.0, "min_child_weight": 2, "scale_pos_weight": 5}),
        ("LightGBM", BOOST | {"colsample_bytree": 0.7, "min_child_samples": 10, "class_weight": "balanced"}),
        ("Gradient Boosting", BOOST | {"max_features": None, "min_samples_leaf": 2, "validation_fraction": 0.2, "tol": 1e-4}),
    ],
)
def test_a_model_grown_in_a_task_is_sparks_model(spark, blobs, name, params, tmp_path):
    fit = tuning.BUILDERS[name](params)
    want, got = fit.alone(blobs), fit(blobs)
    assert type(got.model) is type(want.model) and got.has_probability
    scores = {m: {r["row_id"]: r["score"] for r in f.score(blobs).collect()} for m, f in (("want", want), ("got", got))}
    apart = [abs(scores["want"][i] - scores["got"][i]) for i in scores["want"]]
    assert len(apart) == 500 and np.mean(apart) < (1e-9 if params == TREE or name == "Gradient Boosting" else 0.1)
    f1 = [metrics.binary_scores(f.score(blobs), "label", "prediction").first()["f1"] for f in (want, got)]
    assert f1[0] == pytest.approx(f1[1], abs=1e-9 if params == TREE or name == "Gradient Boosting" else 0.05)
    x = np.array([r["x"] for r in blobs.select("row_id", vector_to_array("features").alias("x")).orderBy("row_id").collect()])
    if name in ("Decision Tree", "XGBoost"):  # drawn alike, so the kept trees say what the counts of a search say
        y = np.array([float(i % 3 == 0) for i in range(500)])
        says = trees.predicted(trees.Rows(trees.binned(x, np.ones(500, bool))), y, np.ones(500, bool), np.zeros(500), fit.recipe())
        assert [r["prediction"] for r in got.score(blobs).orderBy("row_id").collect()] == says.astype(float).tolist()
    if name == "Random Forest":
        assert got.model.getNumTrees == 40 and sum(got.model.featureImportances) == pytest.approx(1) and got.model.getImpurity() == "entropy"
    elif name == "LightGBM":
        assert got.model.treeWeights == want.model.treeWeights
    elif name == "AdaBoost":
        assert len(got.model.trees) == len(want.model.trees)


def test_sums_of_larger_children_are_those_counted(monkeypatch):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(900, 6)), 1)
    y = (x[:, 0] * x[:, 1] + 0.3 * rng.normal(size=900) > 0).astype(float)
    rows, c = trees.Rows(trees.binned(x, np.ones(900, bool))), rng.poisson(1.0, 900).astype(float)
    weight = np.where(y > 0.5, 3.0, 0.5)
    target = c * weight * (y - 0.5) * rng.integers(1, 5, 900)  # sums of these are exact
    cases = [
        (c * weight, c * weight * y, c, trees.Recipe("forest", 1, 8, 2, bootstrap=True, entropy=e), True, (0.5, 3.0)) for e in (False, True)
    ] + [
        (np.ones(900), (y - 0.5) * rng.integers(1, 5, 900), np.ones(900), trees.Recipe("boosted", 1, 8, 3), False, (1.0, 1.0)),
        (weight, weight * y, np.ones(900), trees.Recipe("ada", 1, 8), True, None),
        ((c > 0) * weight, (c > 0) * target, (c > 0).astype(float), trees.Recipe("boosted", 1, 8, 1, 0.7), False, (0.5, 3.0)),
    ]
    for kept in (0, 1 << 30):
        monkeypatch.setattr(trees, "KEPT_ROWS", kept)
        grown = [rows.tree(*case[:4], np.random.default_rng(2), *case[4:]) for case in cases]
        if kept:
            for (one, tree), (other, same) in zip(first, grown):
                assert (one == other).all() and (tree.sums == same.sums).all() and (tree.left == same.left).all() and len(tree.left) > 9
        first = grown


def test_no_model_that_fits_in_a_task_is_left_to_spark(blobs):
    def alone(frame):
        raise AssertionError("fitted by Spark")

    fit = tuning.BUILDERS["Decision Tree"](TREE)
    assert replace(fit, alone=alone)(blobs).score(blobs).count() == 500
