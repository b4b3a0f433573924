"""Fitted stages, models and indexes are saved, loaded and give the same rows."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import functions as F

from tamarack.catalog.learn import examples
from tamarack.catalog.registry import Tables, movies_of, reviews_of
from tamarack.operators import metrics, models
from tamarack.operators.evaluation import BinaryScorer
from tamarack.operators.neighbours import index_neighbours, knn, search_index
from tamarack.operators.similarity import fit_pair_cosine, pair_cosine
from tamarack.plans import stages
from tamarack.session import cut_lineage
from tamarack.sources import readers, writers
from tamarack.sources.persisted import load_part, save_part


@pytest.fixture(scope="module")
def reviews(spark, data):
    t = Tables(spark, data)
    return cut_lineage(reviews_of(t).select("review_id", "movie_id", "review_date", "review_text"))


def rows_of(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_a_fitted_pipeline_is_saved_and_loaded(spark, data, reviews, tmp_path):
    plots = movies_of(Tables(spark, data)).select("movie_id", "plot_summary")
    words = spark.createDataFrame([("the", 1.5), ("is", -0.5)], "term string, valence double")
    names = spark.createDataFrame([("The", "GPE")], "surface string, entity_type string")
    chain = Pipeline(
        stages=[
            stages.text_stage("review_id", "review_text", words, ["that"], boosters=("very",)),
            stages.entity_stage("review_id", "review_text", names),
            stages.readability_stage("review_text"), stages.date_stage("review_date"),
            stages.tfidf_stage("review_id", "review_text", 150, 3, use_ngrams=False),
            stages.topic_stage("review_id", "review_text", 2, 100),
            stages.cosine_stage("review_id", "movie_id", "review_text", plots, "plot_summary", "similarity"),
        ]
    )
    chain.write().overwrite().save(str(tmp_path / "unfitted"))
    again = Pipeline.load(str(tmp_path / "unfitted")).getStages()
    assert [type(s) for s in again] == [type(s) for s in chain.getStages()]
    assert again[0].getOrDefault("boosters") == ["very"] and again[0].parts["lexicon"].count() == 2
    fitted = chain.fit(reviews)
    fitted.write().overwrite().save(str(tmp_path / "fitted"))
    loaded = PipelineModel.load(str(tmp_path / "fitted"))
    part = reviews.where("review_id % 5 = 0")
    want, got = rows_of(fitted.transform(part), "review_id"), rows_of(loaded.transform(part), "review_id")
    assert len(want) == part.count() and len(want) > 10
    for a, b in zip(want, got):
        for x, y in zip(a, b):
            assert x == y or np.allclose(x, y, rtol=1e-9, atol=1e-12, equal_nan=True)
    assert fitted.stages[4].uid == loaded.stages[4].uid


def test_cosine_keeps_the_idf_of_its_fit(spark):
    items = spark.createDataFrame([(1, "red fox jumps"), (2, "blue whale"), (3, None), (None, "lost")], "k int, plot string")
    first = spark.createDataFrame([(1, 1, "red fox"), (2, 1, "red hen"), (3, 2, "whale whale song")], "id int, k int, t string")
    second = spark.createDataFrame(
        [(9, 1, "red unicorn"), (8, 2, "blue"), (7, 3, "anything"), (6, 4, "unknown item"), (5, 1, None)], "id int, k int, t string"
    )
    model = fit_pair_cosine(first, items, "id", "k", "t", "plot")
    same = {r["id"]: r["s"] for r in model.transform(first, "id", "t", "s").collect()}
    fitted = {r["id"]: r["s"] for r in pair_cosine(first, items, "id", "k", "t", "plot", "s").collect()}
    assert same.keys() == fitted.keys() and all(abs(same[i] - fitted[i]) < 1e-12 for i in same)
    got = {r["id"]: r["s"] for r in model.transform(second, "id", "t", "s").collect()}
    texts = ["red fox", "red hen", "whale whale song", "red fox jumps", "red fox jumps", "blue whale"]
    idf = {w: np.log(7 / (sum(w in x.split() for x in texts) + 1)) + 1 for x in texts for w in x.split()}
    item = np.array([idf["red"], idf["fox"], idf["jumps"]])
    assert set(got) == {9, 8, 7, 5} and got[7] == got[5] == 0.0
    assert abs(got[9] - idf["red"] / np.linalg.norm(item)) < 1e-12  # the unseen word is left out
    assert abs(got[8] - idf["blue"] / np.hypot(idf["blue"], idf["whale"])) < 1e-12
    assert model.transform(second.limit(0), "id", "t", "s").count() == 0


def test_neighbours_and_ensemble_are_saved_and_loaded(spark, data, tmp_path):
    df = examples(Tables(spark, data)).cache()
    fitted = [models.train(n, df) for n in ("K-Nearest Neighbors", "Decision Tree")]
    fitted.append(models.adaboost(df, rounds=2))
    fitted[-1].name = "AdaBoost"
    writers.save_ensemble(spark, fitted, str(tmp_path / "vote"))
    loaded = readers.load_ensemble(spark, str(tmp_path / "vote"))
    assert [m.name for m in loaded] == [m.name for m in fitted] and all(m.has_probability for m in loaded)
    want, got = (rows_of(models.soft_vote([m.score(df) for m in group]), "row_id") for group in (fitted, loaded))
    assert want == got and len(want) == df.count()
    index = loaded[0].model.index()
    assert index.partitioned and sum(n for n, _, _ in index.stats.values()) == df.count()


def test_a_search_opens_only_the_cells_it_needs(spark, tmp_path):
    values = np.random.default_rng(5).normal(size=(400, 2)) + np.repeat(np.arange(4), 100)[:, None] * 100.0
    base = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(values)], "id long, x array<double>")
    asked = base.where("id < 20")
    index = index_neighbours(base, "id", "x", pivots=12, block=16).written(str(tmp_path / "cells"))
    opened = []
    blocks = index.blocks
    index.blocks = lambda cells: opened.append(cells) or blocks(cells)
    got = rows_of(search_index(index, asked, 3, "id", "x", True), "query_id", "rank")
    assert got == rows_of(knn(asked, base, 3, "id", "id", "x", skip_self=True), "query_id", "rank")
    assert all(0 < len(set(cells)) < len(index.stats) for cells in opened)
    plan = blocks([0])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cell" in plan
    nothing = index_neighbours(base.limit(0), "id", "x").written(str(tmp_path / "none"))
    assert search_index(nothing, asked, 3, "id", "x").count() == 0


@pytest.mark.parametrize("shape", [(0, 3), (1, 4), (5, 2)])
def test_matrices_round_trip(spark, tmp_path, shape):
    matrix = np.random.default_rng(1).normal(size=shape)
    save_part(spark, matrix, str(tmp_path / "m"))
    back = load_part(spark, "array", str(tmp_path / "m"))
    assert len(back) == shape[0] and (shape[0] == 0 or (back == matrix).all())


def test_scorer_serves_spark_validators(spark, data, tmp_path):
    df = examples(Tables(spark, data)).cache()
    learner = LogisticRegression(maxIter=3)
    scored = learner.fit(df).transform(df)
    plain = metrics.binary_scores(scored, "label", "prediction").first()
    for name in ("f1", "balanced_accuracy", "recall"):
        assert BinaryScorer(metricName=name).evaluate(scored) == plain[name]
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    theirs = BinaryClassificationEvaluator(rawPredictionCol="probability", numBins=0).evaluate(scored)
    assert abs(BinaryScorer(metricName="auc").evaluate(scored) - theirs) < 1e-9
    scorer = BinaryScorer(metricName="recall")
    scorer.save(str(tmp_path / "scorer"))
    assert BinaryScorer.load(str(tmp_path / "scorer")).getOrDefault("metricName") == "recall"
    grid = ParamGridBuilder().addGrid(learner.regParam, [0.0, 10.0]).build()
    found = TrainValidationSplit(estimator=learner, estimatorParamMaps=grid, evaluator=scorer, seed=3).fit(df)
    assert len(found.validationMetrics) == 2
    assert BinaryScorer(metricName="f1").evaluate(scored.where(F.lit(False))) == 0.0
    with pytest.raises(ValueError):
        BinaryScorer(metricName="mystery").evaluate(scored)
