"""Operators on literal frames, against expected values or brute force."""

import itertools
import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tamarack.operators import clean, correlation, factors, lexicon, metrics, models, ordering, profile, selection, splitting, tuning
from tamarack.operators.joins import fits, hot_keys, lookup_join, skew_join
from tamarack.operators.neighbours import knn
from tamarack.operators.resample import smote, synthetic_rows
from tamarack.operators.scaling import fit_scaler, standardize_columns
from tamarack.operators.spaces import SPACES, sample_space


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_skew_join_equals_plain_join(spark):
    left = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 100).alias("k"))
    left = left.withColumn("k", F.when(F.col("id") % 50 == 1, None).otherwise(F.col("k")))
    right = spark.range(80).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    assert hot_keys(left, ["k"], 8).count() == 1
    for how in ("inner", "left", "left_semi"):
        got, want = skew_join(left, right, ["k"], ["id"], how), left.join(right, "k", how)
        assert rows(got.select(want.columns), "id") == rows(want, "id")


def test_lookup_join_falls_back_when_large(spark):
    left = spark.range(100).select("id", (F.col("id") % 10).alias("k"))
    right = spark.range(10).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    assert fits(right, 10) and not fits(right, 9) and not fits(right, 100, 10)
    small = lookup_join(left, right, ["k"], ["id"])
    large = lookup_join(left, right, ["k"], ["id"], max_rows=3)
    assert rows(small.select("id", "k", "v"), "id") == rows(large.select("id", "k", "v"), "id")


def test_percentile_rank(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, "a", 2), (4, "a", 5), (5, "a", None)], "i int, g string, x int")
    got = selection.percentile_rank(df, ["g"], "x", "p", ["i"]).select("i", "p")
    assert rows(got, "i") == [(1, 0.25), (2, 0.625), (3, 0.625), (4, 1.0), (5, None)]


def test_quantiles_match_numpy_with_one_hot_group(spark):
    rng = np.random.default_rng(1)
    data = [(("hot" if i % 3 else f"g{i % 7}"), float(rng.integers(0, 500)) / 7) for i in range(2000)]
    df = spark.createDataFrame(data, "g string, x double")
    got = {r["g"]: r for r in selection.exact_quantiles(df, ["g"], "x", {"a": 0.25, "b": 0.5, "c": 0.95}).collect()}
    for g in {d[0] for d in data}:
        x = [v for k, v in data if k == g]
        assert np.allclose([got[g]["a"], got[g]["b"], got[g]["c"]], np.quantile(x, [0.25, 0.5, 0.95]))


def test_quantile_fixture(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (10.0,), (None,)], "x double")
    row = selection.exact_quantiles(df, [], "x", {"a": 0.25, "b": 0.95}).first()
    assert math.isclose(row["a"], 1.75) and math.isclose(row["b"], 9.1)


def test_codes_and_row_index(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "b")], "i int, s string")
    assert rows(ordering.dense_codes(df, "s", "c", ["i"]).select("i", "c"), "i") == [(1, 1), (2, 0), (3, -1), (4, 1)]
    index = ordering.row_index(spark.range(5, 105).toDF("k"), "k", "n")
    assert rows(index.select("k", "n"), "k") == [(k, k - 5) for k in range(5, 105)]


def test_keep_first(spark):
    df = spark.createDataFrame([(3, "x"), (1, "x"), (2, "y"), (4, None), (5, None)], "i int, t string")
    assert rows(clean.keep_first(df, "t", ["i"]).select("i"), "i") == [(1,), (2,), (4,)]


def test_single_row_std_is_null(spark):
    df = spark.createDataFrame([("a", 1.0)], "g string, x double")
    assert rows(profile.group_stats(df, ["g"], "x", "r"), "g") == [("a", 1.0, 1.0, None)]


def test_histogram_maximum_and_month_gaps(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 1, 10)], "x double")
    got = profile.histograms(df, ["x"], 5)
    assert rows(got.select("bin", "n"), "bin") == [(1, 2), (2, 0), (3, 0), (4, 0), (5, 1)]
    dates = spark.createDataFrame([("2020-01-05",), ("2020-04-02",), (None,)], "d string").select(F.col("d").cast("date"))
    assert [r[1] for r in rows(profile.monthly_counts(dates, "d"), "month_end")] == [1, 0, 0, 1]


def test_exploded_empty_list(spark):
    df = spark.createDataFrame([(["a", "b"],), ([],)], "l array<string>")
    assert sorted(str(r[0]) for r in profile.exploded(df, "l", []).collect()) == ["None", "a", "b"]


def test_constant_column_and_target_left_out(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1), (1.0, 3.0, 2), (1.0, None, 3)], "a double, b double, y int")
    got = dict(rows(correlation.target_correlation(df, ["a", "b", "y"], "y"), "feature"))
    assert got["a"] is None and math.isclose(got["b"], 1.0) and "y" not in got


def test_population_scaling(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    assert rows(standardize_columns(df, ["x"]), "x") == [(-1.0,), (1.0,)]
    vec = df.select(array_to_vector(F.array("x", F.lit(5.0))).alias("v"))
    scaled = fit_scaler(vec, "v").transform(vec, "v", "z").select("z").collect()
    assert sorted(list(r[0]) for r in scaled) == [[-1.0, 0.0], [1.0, 0.0]]


def test_split_sizes_and_repeatability(spark):
    counts = spark.createDataFrame([(0, 422522), (1, 150856)], "y int, n bigint")
    assert rows(splitting.largest_remainder(counts, "y", math.ceil(573378 * 0.2)), "y") == [(0, 84505), (1, 30171)]
    df = spark.range(1000).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    train, test = splitting.train_test_split(df, "y", "id")
    assert train.count() == 800 and test.count() == 200
    assert train.join(test, "id").count() == 0
    assert rows(test.groupBy("y").count(), "y") == [(0, 180), (1, 20)]
    again = splitting.train_test_split(df.repartition(3), "y", "id")[1]
    assert rows(test.select("id"), "id") == rows(again.select("id"), "id")
    folds = splitting.with_folds(df, "y", "id", 5).groupBy("y", "fold").count()
    assert {r["count"] for r in folds.collect()} == {20, 180}


@pytest.mark.parametrize("metric", ["euclidean", "manhattan", "chebyshev"])
def test_knn_matches_brute_force(spark, metric):
    rng = np.random.default_rng(3)
    points = rng.integers(0, 6, (300, 4)).astype(float)
    points[:100] = points[0]
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id bigint, x array<double>")
    order = {"euclidean": lambda g: np.sqrt((g * g).sum(-1)), "manhattan": lambda g: np.abs(g).sum(-1), "chebyshev": lambda g: np.abs(g).max(-1)}
    got = knn(df, df, 4, "id", "id", "x", metric, skip_self=True, pivots=5, block=32)
    found = {}
    for r in got.collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["neighbour_id"], r["distance"]))
    gaps = order[metric](points[:, None] - points[None])
    for i in range(300):
        best = sorted((gaps[i, j], j) for j in range(300) if j != i)[:4]
        assert [(n, round(d, 9)) for _, n, d in sorted(found[i])] == [(j, round(d, 9)) for d, j in best]


def test_smote_parity_and_position(spark):
    rng = np.random.default_rng(5)
    data = [(i, rng.normal(size=3).tolist(), int(i < 12)) for i in range(90)]
    df = spark.createDataFrame(data, "id bigint, x array<double>, y int")
    grown = smote(df, "id", "x", "y")
    assert rows(grown.groupBy("y").count(), "y") == [(0, 78), (1, 78)]
    made = synthetic_rows(df.where("y = 1"), "id", "x", 66, 4, 42).collect()
    points = {i: np.array(x) for i, x, _ in data}
    for r in made:
        a, b = points[r["base_id"]], points[r["neighbour_id"]]
        assert np.allclose(r["x"], a + r["share"] * (b - a)) and r["base_id"] != r["neighbour_id"]
    assert len({r["synthetic_id"] for r in made}) == 66
    alone = spark.createDataFrame(data[11:], "id bigint, x array<double>, y int")
    assert smote(alone, "id", "x", "y").count() == len(data) - 11


def test_metrics_golden(spark):
    cells = [(0, 0, 59671), (0, 1, 24834), (1, 0, 9383), (1, 1, 20788)]
    df = spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(a).alias("y"), F.lit(b).alias("p"), F.lit(n).alias("n")) for a, b, n in cells])))
    wide = df.select("y", "p", F.explode(F.sequence(F.lit(1), "n")))
    row = metrics.binary_scores(wide, "y", "p").first()
    assert [round(row[c], 4) for c in ("accuracy", "precision", "recall", "f1")] == [0.7016, 0.4557, 0.6890, 0.5485]
    report = {r["row"]: r for r in metrics.classification_report(wide, "y", "p").collect()}
    assert round(report["1"]["f1"], 2) == 0.55 and report["weighted avg"]["support"] == 114676


def test_auc_and_average_precision(spark):
    rng = np.random.default_rng(2)
    y, s = rng.integers(0, 2, 300), rng.integers(0, 40, 300) / 40
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, s double")
    pairs = list(itertools.product(s[y == 1], s[y == 0]))
    want = np.mean([1.0 if a > b else 0.5 if a == b else 0.0 for a, b in pairs])
    assert math.isclose(metrics.roc_auc(df, "y", "s").first()["auc"], want)
    ap, recall = 0.0, 0.0
    for threshold in sorted(set(s), reverse=True):
        said = s >= threshold
        tp = (said & (y == 1)).sum()
        ap += (tp / y.sum() - recall) * tp / said.sum()
        recall = tp / y.sum()
    assert math.isclose(metrics.average_precision(df, "y", "s").first()["average_precision"], ap)


def test_sentiment_rules(spark):
    words = spark.createDataFrame([("good", 2.0), ("bad", -2.5)], "term string, valence double")
    texts = ["good", "not good", "very good", "good!!", "good but bad", "GOOD day", "nothing", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = lexicon.with_sentiment(df, "id", "t", words, boosters=["very"], negations=["not"])
    squash = lambda s: round(s / math.sqrt(s * s + 15), 4)
    want = [2.0, 2.0 * -0.74, 2.293, 2.0 + 2 * 0.292, 2.0 * 0.5 - 2.5 * 1.5, 2.733, 0.0, 0.0]
    assert [r["compound_sentiment_score"] for r in got.orderBy("id").collect()] == [squash(s) for s in want]


def test_entities_longest_first(spark):
    names = spark.createDataFrame(
        [("New York", "GPE"), ("York", "GPE"), ("York Times", "ORGANIZATION"), ("Ann", "PERSON")], "surface string, entity_type string"
    )
    df = spark.createDataFrame([(1, "Ann left New York Times Square for York."), (2, None)], "id int, t string")
    got = lexicon.with_entity_counts(df, "id", "t", names).orderBy("id").collect()
    assert (got[0]["entity_GPE"], got[0]["entity_ORGANIZATION"], got[0]["entity_PERSON"]) == (2, 0, 1)
    assert got[1]["entity_GPE"] == 0


def test_svd_matches_numpy(spark):
    rng = np.random.default_rng(0)
    matrix = rng.normal(size=(60, 12)) * (rng.random((60, 12)) < 0.5)
    data = [(i, {j: float(v) for j, v in enumerate(r) if v}) for i, r in enumerate(matrix)]
    from pyspark.ml.linalg import Vectors, VectorUDT
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", VectorUDT())])
    df = spark.createDataFrame([(i, Vectors.sparse(12, d)) for i, d in data], schema)
    model = factors.fit_svd(df, "v", 12, 3, oversample=9)
    assert np.allclose(model.singular_values, np.linalg.svd(matrix)[1][:3])
    got = np.array([list(r)[1:] for r in model.transform(df, "id", "v").orderBy("id").collect()])
    assert np.allclose(got, matrix @ model.components)


def test_pca_fall_through_keeps_everything(spark):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(r.tolist(),) for r in rng.normal(size=(80, 6))], "x array<double>").select(
        array_to_vector("x").alias("v")
    )
    short = factors.fit_pca(df, "v", "o", 0.95, max_components=2)
    assert (short.components, short.reached) == (2, False)
    full = factors.fit_pca(df, "v", "o", 0.95)
    assert full.reached and np.cumsum(full.ratios)[full.components - 1] >= 0.95
    mean = np.mean([r["o"].toArray() for r in full.transform(df).collect()], axis=0)
    assert np.allclose(mean, 0)


def _blobs(spark):
    rng = np.random.default_rng(9)
    data = [(i, int(i % 4 == 0), (rng.normal(size=3) + (2.5 if i % 4 == 0 else 0)).tolist()) for i in range(240)]
    return spark.createDataFrame(data, "row_id bigint, label int, x array<double>").select(
        "row_id", "label", array_to_vector("x").alias("features")
    )


@pytest.mark.parametrize("name", ["Logistic Regression", "SGD Classifier", "K-Nearest Neighbors", "Decision Tree", "Linear SVC"])
def test_models_learn(spark, name):
    df = _blobs(spark).cache()
    row = models.board_row(models.train(name, df), df).first()
    assert row["Model"] == name and row["F1-Score"] > 0.75 and row["AUC-ROC"] > 0.9


def test_adaboost_learns(spark):
    df = _blobs(spark).cache()
    fitted = models.adaboost(df, rounds=12)
    fitted.name = "AdaBoost"
    assert models.board_row(fitted, df).first()["AUC-ROC"] > 0.9


def test_every_draw_builds_and_deep_or_failing_candidates_do_not_end_a_search(spark, monkeypatch):
    for name in SPACES:
        for drawn in sample_space(name, 100):
            assert tuning.BUILDERS[name](drawn) and (tuning.effective(drawn).get("max_depth") or 0) <= 30
    df = _blobs(spark).cache()
    deep = {"n_estimators": 3, "max_depth": 49, "min_samples_leaf": 1, "max_features": None, "bootstrap": True, "criterion": "gini",
            "max_samples": 0.9, "class_weight": None}
    assert metrics.binary_scores(tuning.BUILDERS["Random Forest"](deep)(df).score(df), "label", "prediction").first()["f1"] > 0.8
    monkeypatch.setattr(tuning, "sample_space", lambda *a: [deep, deep | {"min_samples_leaf": -1}])
    found = tuning.random_search("Random Forest", df, candidates=2, folds=2)
    noted = {r["candidate"]: r["error"] for r in found.scores.collect()}
    assert noted[0] is None and noted[1] and found.best_params == deep
    assert all("'max_depth': 30" in r["params"] for r in found.scores.collect())


def test_positive_weights_reach_the_learner(spark):
    boost = {"n_estimators": 3, "max_depth": 2, "learning_rate": 0.1, "subsample": 1.0, "colsample_bytree": 0.7, "min_child_weight": 1}
    df = _blobs(spark).select("row_id", "label", array_to_vector(F.array(F.rand(3))).alias("features")).cache()
    share = [tuning.BUILDERS["XGBoost"](boost | {"scale_pos_weight": w})(df).score(df).agg(F.avg("score")).first()[0] for w in (1, 5, 10)]
    assert share[0] < share[1] < share[2]


def test_vote_uses_members_with_probability_only(spark):
    df = _blobs(spark).cache()
    fitted = [models.train(n, df) for n in ("Linear SVC", "Decision Tree", "Logistic Regression")]
    assert not fitted[0].has_probability
    vote = models.vote_of_best(fitted, models.leaderboard(fitted, df), df)
    assert vote.count() == 240 and vote.where("score < 0 or score > 1").count() == 0


def test_search_spaces_are_repeatable():
    for name in SPACES:
        drawn = sample_space(name, 5)
        assert drawn == sample_space(name, 5) and len(drawn) == 5
    depths = [d["max_depth"] for d in sample_space("Decision Tree", 200)]
    assert None in depths and all(d is None or 5 <= d < 50 for d in depths)


def test_a_dropped_mention_blocks_nothing(spark):
    names = spark.createDataFrame([("A B", "X"), ("B C D", "Y"), ("D E", "Z")], "surface string, entity_type string")
    df = spark.createDataFrame([(1, "A B C D E"), (2, "B C D E"), (3, None)], "i int, t string")
    got = lexicon.entity_mentions(df, "i", F.col("t"), names).orderBy("i", "place").collect()
    assert [tuple(r) for r in got] == [(1, 1, 2, "X"), (1, 4, 2, "Z"), (2, 1, 3, "Y")]


def test_describe_keeps_every_column(spark):
    df = spark.createDataFrame(
        [(None, 1, [1], None), (None, 2, [1], None)], "a double, b byte, c array<int>, d string"
    ).withColumn("e", F.lit("1.5").cast("decimal(5,2)"))
    got = {r["feature"]: r for r in profile.describe(df).collect()}
    assert set(got) == set("abcde")
    assert (got["a"]["count"], got["d"]["count"], got["d"]["unique"], got["b"]["mean"], got["e"]["max"]) == (0, 0, 0, 1.5, 1.5)
    assert (got["c"]["top"], got["c"]["freq"]) == ("[1]", 2)


def test_null_labels_are_a_class_of_the_split(spark):
    df = spark.range(100).select("id", F.when(F.col("id") < 10, None).otherwise(F.col("id") % 3).alias("y"))
    train, test = splitting.train_test_split(df, "y", "id", 0.2)
    assert (train.count(), test.count(), test.where("y IS NULL").count()) == (80, 20, 2)
    folded = splitting.with_folds(df, "y", "id", 5)
    assert sorted(r["count"] for r in folded.where("y IS NULL").groupBy("fold").count().collect()) == [2] * 5


def test_many_classes_and_many_ranges(spark):
    df = spark.range(30000).select("id", (F.col("id") % 12000).alias("y"))
    picked = splitting.stratified_pick(df, "y", "id", 6000).where("picked")
    assert picked.count() == 6000
    totals = ordering.running_totals(df.select("id", F.lit(1).cast("long").alias("n")), [], "id", ["n"], ranges=1500)
    assert totals.where("n_before <> id").count() == 0 and totals.count() == 30000


def test_curves_have_their_end_points(spark):
    df = spark.createDataFrame([(0, 0.1), (1, 0.4), (0, 0.35), (1, 0.8)], "y int, s double")
    roc = {(r["fpr"], r["tpr"]) for r in metrics.roc_curve(df, "y", "s").collect()}
    assert {(0.0, 0.0), (1.0, 1.0)} <= roc and len(roc) == 5
    assert (1.0, 0.0) in {(r["precision"], r["recall"]) for r in metrics.precision_recall_curve(df, "y", "s").collect()}


def test_ranges_of_numbers_are_found_by_search(spark):
    """Running totals over odd numbers, and without comparing each row with lists of borders."""
    values = [None, -math.inf, -1.5, -0.0, 1e-300, 2.0, float(2**60), math.inf, math.nan, *np.random.default_rng(4).normal(size=300).tolist()]
    df = spark.createDataFrame([(v, k + 1) for k, v in enumerate(values)], "v double, n long")
    got = ordering.running_totals(df, [], "v", ["n"], ranges=40)
    assert "lambda" not in got._jdf.queryExecution().optimizedPlan().toString()
    keyed = sorted(zip(values, range(1, len(values) + 1)), key=lambda p: (p[0] is not None, p[0] is not None and math.isnan(p[0]), p[0] or 0.0))
    want, before = {}, 0
    for _, n in keyed:
        want[n], before = before, before + n
    assert {r["n"]: r["n_before"] for r in got.collect()} == want and got.select("n_total").distinct().collect() == [(before,)]
    big = [2**63 - 1, 2**63 - 2, 2**53 + 1, 2**53, -(2**63), 0]
    longs = ordering.running_totals(spark.createDataFrame([(b, 1) for b in big], "v long, n long"), [], "v", ["n"], ranges=3)
    assert [r["v"] for r in longs.orderBy("n_before").collect()] == sorted(big)
    for odd in ([], [(None, 1)], [(math.nan, 1)], [(math.inf, 1)]):
        rows_ = ordering.running_totals(spark.createDataFrame(odd, "v double, n long"), [], "v", ["n"]).collect()
        assert [r["n_before"] for r in rows_] == [0] * len(odd)
