"""Sources, sinks and the end-to-end flows on small files."""

import json
import os

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tamarack.catalog.learn import examples, feature_config
from tamarack.catalog.registry import QUERIES, Tables, movies_of, reviews_of
from tamarack.operators import models, tuning
from tamarack.operators.factors import fit_pca
from tamarack.operators.splitting import train_test_split
from tamarack.plans import training as training_plan
from tamarack.plans.explore import engineered_report, initial_report, pair_sample
from tamarack.plans.features import build_features
from tamarack.plans.ingest import clean_movies, clean_reviews
from tamarack.plans.splits import prepare, write_variants
from tamarack.plans.training import compare_variants, tune
from tamarack.session import cut_lineage
from tamarack.sources import readers, writers


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    reviews = [
        {"review_date": "10 February 2006", "movie_id": "tt1", "user_id": "ur2", "is_spoiler": True,
         "review_text": "It ends\nwith a \"twist\".", "rating": "10", "review_summary": "Wow"},
        {"review_date": "9 February 2006", "movie_id": "tt2", "user_id": "ur1", "is_spoiler": False,
         "review_text": "Fine, I guess.", "rating": "7", "review_summary": None},
        {"review_date": "12 February 2006", "movie_id": "tt1", "user_id": "ur9", "is_spoiler": False,
         "review_text": "It ends\nwith a \"twist\".", "rating": "1", "review_summary": "Copy"},
    ]
    movies = [
        {"movie_id": "tt1", "plot_summary": "A twist.", "duration": "2h 30min", "genre": ["Drama", "Children's"],
         "rating": "7.5", "release_date": "2005", "plot_synopsis": ""},
        {"movie_id": "tt2", "plot_summary": "Plain.", "duration": "45min", "genre": [], "rating": "6", "release_date": "2006-02-01",
         "plot_synopsis": None},
    ]
    for name, rows in (("reviews", reviews), ("movies", movies)):
        with open(folder / f"{name}.json", "w") as f:
            f.write("\n".join(json.dumps(r) for r in rows))
    return folder


def test_ingest_and_csv_round_trip(spark, raw, tmp_path):
    reviews = clean_reviews(readers.read_reviews_json(spark, str(raw / "reviews.json")))
    movies = clean_movies(readers.read_movies_json(spark, str(raw / "movies.json")))
    got = {r["movie_id"]: r for r in reviews.collect()}
    assert sorted(r["review_id"] for r in got.values()) == [0, 1]
    assert (got["tt1"]["review_summary"], got["tt1"]["rating"], got["tt1"]["user_id"]) == ("Wow", 10, 1)
    assert str(got["tt1"]["review_date"]) == "2006-02-10" and got["tt2"]["user_id"] == 0
    writers.write_csv(reviews.drop("review_id").select([f.name for f in readers.schemas.CSV_REVIEWS]), str(tmp_path / "r"))
    writers.write_csv(movies, str(tmp_path / "m"))
    back = {r["movie_id"]: r for r in readers.read_reviews_csv(spark, str(tmp_path / "r")).collect()}
    assert back["tt1"]["review_text"] == got["tt1"]["review_text"] and back["tt1"]["review_date"] == got["tt1"]["review_date"]
    genres = {r["movie_id"]: r["genre"] for r in readers.read_movies_csv(spark, str(tmp_path / "m")).collect()}
    assert genres == {"tt1": ["Drama", "Children's"], "tt2": []}
    assert readers.shape(reviews) == (2, 8)


@pytest.fixture(scope="module")
def final(spark, data):
    t = Tables(spark, data)
    tables = build_features(reviews_of(t), movies_of(t), feature_config(t, components=6, topics=3, max_features=300))
    return cut_lineage(tables["final_engineered"])


def test_feature_table_contract(spark, data, final):
    assert len(final.columns) == 180 + 1 - (100 - 6) - (10 - 3)
    assert final.count() == final.select("review_id").distinct().count() == reviews_of(Tables(spark, data)).count()
    topics = sum(F.col(f"topic_{i}") for i in range(3))
    assert final.where(F.abs(topics - 1) > 1e-6).count() == 0
    assert final.where("cosine_sim_review_plot < 0 or cosine_sim_review_plot > 1.000001").count() == 0
    assert {"rating_x", "rating_y", "rating_median", "entity_GPE", "smog_index", "has_plot twist"} <= set(final.columns)


def test_reports_build(spark, data, final):
    t = Tables(spark, data)
    for name, build in initial_report(reviews_of(t), movies_of(t)).items():
        assert build().limit(3).collect() is not None, name
    report = engineered_report(final)
    for name in ("class_share", "target_correlation", "pair_features", "feature_ranking", "rate_by_release_lag"):
        assert report[name]().count() > 0, name
    assert report["rate_by_genre"]().count() == 0  # fewer than 100 reviews per genre here
    assert pair_sample(final, "review_id", ["word_count"], "is_spoiler", 20).count() == 20


def test_splits_training_and_tuning(spark, final, tmp_path):
    prepared = prepare(final)
    (train, test), (grown, _) = prepared.variants["base"], prepared.variants["smote"]
    sizes = {r["label"]: r["count"] for r in grown.groupBy("label").count().collect()}
    assert sizes[0] == sizes[1] == max(r["count"] for r in train.groupBy("label").count().collect())
    meta = prepared.metadata.first()
    assert meta["n_features"] == len(prepared.feature_names) and meta["class_distribution_train_smote"] == sizes
    write_variants(prepared, str(tmp_path / "splits"))
    back = readers.read_split(spark, str(tmp_path / "splits"), "SMOTE", "train")
    assert back.count() == grown.count() and back.columns == ["row_id", "label", "features"]
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(variant" in plan
    combined, best = compare_variants(
        spark, str(tmp_path / "splits"), str(tmp_path / "reports"), ["BASE", "SMOTE"], ["Decision Tree", "Logistic Regression"],
        str(tmp_path / "models"),
    )
    assert combined.count() == 4 and best.count() == 2
    assert os.path.isdir(tmp_path / "models" / "base" / "decision_tree_model")
    board = readers.read_leaderboard(spark, str(tmp_path / "reports" / "base" / "model_comparison"))
    assert {r["Model"] for r in board.collect()} == {"Decision Tree", "Logistic Regression"}
    tune(spark, "Decision Tree", str(tmp_path / "splits"), str(tmp_path / "tuned"), ["BASE"], candidates=1, folds=2, models=str(tmp_path / "best"))
    assert os.path.isdir(tmp_path / "best" / "decision_tree_base") and os.path.isdir(tmp_path / "tuned" / "decision_tree_base_curve")
    saved = spark.read.json(str(tmp_path / "tuned" / "decision_tree_base")).first()
    assert saved["data_type"] == "BASE" and saved["best_params"]["criterion"] in ("gini", "entropy")


def test_search_and_failed_model(spark, data):
    train, _ = train_test_split(examples(Tables(spark, data)), "label", "row_id")
    found = tuning.random_search("Decision Tree", train, candidates=2, folds=2)
    assert found.scores.count() == 4 and found.best.name == "Decision Tree"
    broken = models.train_all(train, ["no such model", "Decision Tree"])
    assert list(broken.failed) == ["no such model"] and len(broken.fitted) == 1


def test_search_goes_on_where_it_was_cut_short(spark, data, monkeypatch, tmp_path):
    train = cut_lineage(train_test_split(examples(Tables(spark, data)), "label", "row_id")[0])
    ledger, fits, note = str(tmp_path / "ledger"), [], tuning.Ledger.note
    build = tuning.BUILDERS["Decision Tree"]

    def counted(params):
        fit = build(params)
        return lambda frame: fits.append(str(params)) or fit(frame)

    def full(self, name, found):
        if len(self.known) >= 3:
            raise OSError("the driver is lost here")
        note(self, name, found)

    monkeypatch.setitem(tuning.BUILDERS, "Decision Tree", counted)
    monkeypatch.setattr(tuning.Ledger, "note", full)
    with pytest.raises(tuning.LostLedger):
        tuning.random_search("Decision Tree", train, candidates=4, folds=2, parallel=1, ledger=ledger)
    done = spark.read.json(ledger).count()
    assert done == 3
    monkeypatch.setattr(tuning.Ledger, "note", note)
    fits.clear()
    found = tuning.random_search("Decision Tree", train, candidates=4, folds=2, ledger=ledger)
    assert len(fits) == 8 - done + 1  # what was missing, and the winner on all rows
    fits.clear()
    again = tuning.random_search("Decision Tree", train.repartition(3), candidates=4, folds=2, ledger=ledger)
    assert len(fits) == 1 and again.best_params == found.best_params and again.scores.collect() == found.scores.collect()
    fits.clear()
    cv = tuning.cross_validate("Decision Tree", found.best_params, train, 2, ledger=ledger)
    assert not fits and sum(cv) / 2 == pytest.approx(found.best_f1)
    assert tuning.cross_validate("Decision Tree", found.best_params, train, 2) == pytest.approx(cv)  # as without a ledger
    other = train.where("row_id > 5")
    fits.clear()
    tuning.random_search("Decision Tree", other, candidates=1, folds=2, ledger=ledger)
    assert len(fits) == 3  # other rows, other scores


def test_tuning_queries_do_the_whole_search(spark, data, monkeypatch):
    search, seen = tuning.random_search, []

    def few(name, train, candidates=100, folds=5, ledger=None):
        seen.append((name, train.count(), candidates, folds))
        return search(name, train, 2, 2, ledger=ledger)

    rows = train_test_split(examples(Tables(spark, data)), "label", "row_id")[0].count()
    monkeypatch.setattr(tuning, "random_search", few)
    assert all(f"{q}_{m.lower().replace(' ', '_').replace('-', '_')}" in QUERIES for q in ("random_search", "cv_scores", "learning_curve") for m in models.TRAINERS)
    assert QUERIES["cv_scores_decision_tree"](spark, data).first()["cv_f1_std"] >= 0 and seen == [("Decision Tree", rows, 100, 5)]
    best = {}
    monkeypatch.setattr(tuning, "learning_curve", lambda fit, train: best.setdefault("rows", train.count()))
    assert QUERIES["learning_curve_decision_tree"](spark, data) == rows and len(seen) == 2


def test_vote_takes_all_ten(spark, data, monkeypatch):
    asked, every = [], models.train_all
    monkeypatch.setattr(models, "train_all", lambda frame, names: asked.extend(names) or every(frame, ["Decision Tree", "Logistic Regression", "Random Forest"]))
    assert QUERIES["soft_vote_ensemble"](spark, data).count() > 0 and asked == list(models.TRAINERS)


def test_a_vote_without_one_of_the_ten_is_no_result(spark, data, monkeypatch, tmp_path):
    def broken(frame):
        raise ValueError("no such leaf")

    quick = {name: models.TRAINERS["Decision Tree"] for name in models.TRAINERS}
    monkeypatch.setattr(models, "TRAINERS", quick | {"AdaBoost": broken})
    with pytest.raises(RuntimeError, match="AdaBoost could not be trained: ValueError: no such leaf"):
        QUERIES["soft_vote_ensemble"](spark, data)
    rows = spark.range(40).selectExpr("id row_id", "cast(id % 2 as int) label", "array(cast(id % 2 as double), 1D) x").select(
        "row_id", "label", array_to_vector("x").alias("features")
    )
    monkeypatch.setattr(training_plan, "read_split", lambda *a: rows)
    with pytest.raises(RuntimeError, match=r"AdaBoost \(BASE\) could not be trained"):
        compare_variants(spark, "", str(tmp_path), ["BASE"], ["Decision Tree", "AdaBoost"])
    assert readers.read_leaderboard(spark, str(tmp_path / "all_model_comparison")).count() == 1


def test_models_train_at_the_same_time(spark, data, monkeypatch):
    import threading

    meeting = threading.Barrier(3, timeout=60)

    def waits(frame):
        meeting.wait()
        return models.decision_tree(frame)

    monkeypatch.setattr(models, "TRAINERS", models.TRAINERS | {"First": waits, "Second": waits, "Third": waits})
    rows = examples(Tables(spark, data))
    training = models.train_all(rows, ["Third", "no such model", "First", "Second"])
    assert [m.name for m in training.fitted] == ["Third", "First", "Second"] and list(training.failed) == ["no such model"]
    assert [r["Model"] for r in models.leaderboard(training.fitted, rows).collect()] == ["Third", "First", "Second"]


def test_boosting_fills_the_slots(spark):
    from tamarack.operators import boosting

    rows = spark.range(4000).repartition(4).select(F.array([F.rand(k) for k in range(100)]).alias("x"))
    held = boosting._held(rows)
    assert held.rdd.getNumPartitions() >= min(3, spark.sparkContext.defaultParallelism)
    held.unpersist()


def test_stages_in_a_spark_pipeline(spark, data):
    from pyspark.ml import Pipeline

    from tamarack.plans import stages

    t = Tables(spark, data)
    reviews = reviews_of(t).select("review_id", "movie_id", "review_date", "review_text")
    plots = movies_of(t).select("movie_id", "plot_summary")
    chain = Pipeline(
        stages=[
            stages.text_stage("review_id", "review_text"), stages.readability_stage("review_text"), stages.date_stage("review_date"),
            stages.tfidf_stage("review_id", "review_text", 200, 3, use_hashing=True), stages.topic_stage("review_id", "review_text", 2, 200),
            stages.cosine_stage("review_id", "movie_id", "review_text", plots, "plot_summary", "similarity"),
        ]
    )
    out = chain.fit(reviews).transform(reviews)
    assert out.count() == reviews.count()
    assert {"word_count", "smog_index", "review_year", "svd_2", "topic_1", "similarity"} <= set(out.columns)


def test_models_load_again(spark, data, tmp_path):
    from tamarack.operators.scaling import Scaler, fit_scaler

    df = examples(Tables(spark, data)).cache()
    scaler = fit_scaler(df, "features")
    writers.save_arrays(spark, scaler, str(tmp_path / "scaler"))
    assert (readers.load_arrays(spark, Scaler, str(tmp_path / "scaler")).mean == scaler.mean).all()
    for name in ("Decision Tree", "SGD Classifier"):
        fitted = models.train(name, df)
        assert writers.save_fitted(spark, fitted.model, str(tmp_path / name))
        again = readers.load_model(spark, str(tmp_path / name))
        want = fitted.model.transform(df).select("row_id", "prediction").orderBy("row_id").collect()
        assert again.transform(df).select("row_id", "prediction").orderBy("row_id").collect() == want
    boosted = models.adaboost(df, rounds=3).model
    writers.save_fitted(spark, boosted, str(tmp_path / "boosted"))
    assert readers.load_boosted(spark, str(tmp_path / "boosted")).weights == boosted.weights


def test_fitted_pca_is_saved_and_loaded(spark, data, tmp_path):
    rows = examples(Tables(spark, data))
    fitted = fit_pca(rows, "features", "reduced", 0.6, 20)
    assert writers.save_fitted(spark, fitted, str(tmp_path / "pca"))
    loaded = readers.load_reduced(spark, str(tmp_path / "pca"))
    assert (loaded.components, loaded.reached) == (fitted.components, fitted.reached)
    assert loaded.ratios.tolist() == fitted.ratios.tolist()
    want, got = (m.transform(rows).select("row_id", "reduced").orderBy("row_id").collect() for m in (fitted, loaded))
    assert want == got
