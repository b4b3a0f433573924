"""End-to-end features, splits, trained models and tuning. Iterative work: no SQL equivalent."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.catalog.registry import Tables, movies_of, query, reviews_of
from tamarack.catalog.texts import BOOSTERS, DAMPENERS, NEGATIONS, name_list, word_valences
from tamarack.operators import models, tuning
from tamarack.operators.splitting import train_test_split
from tamarack.plans.features import FeatureConfig, build_features
from tamarack.plans.splits import prepare
from tamarack.session import cut_lineage, ensure_checkpoint_dir


def feature_config(t: Tables, **changes) -> FeatureConfig:
    return FeatureConfig(
        lexicon=word_valences(t), gazetteer=name_list(t), boosters=BOOSTERS, dampeners=DAMPENERS,
        negations=NEGATIONS, **changes,
    )


@query("engineered_features")
def engineered_features(t: Tables) -> DataFrame:
    """All 180 columns of the feature table (and the review id)."""
    return build_features(reviews_of(t), movies_of(t), feature_config(t))["final_engineered"]


@query("engineered_splits")
def engineered_splits(t: Tables) -> DataFrame:
    """Rows and class counts of every variant and split, from the engineered features."""
    prepared = prepare(cut_lineage(engineered_features(t)))
    out = None
    for variant, frames in prepared.variants.items():
        for split, frame in zip(("train", "test"), frames):
            part = frame.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.max(F.size(F.unwrap_udt("features").getField("values"))).alias("width"))
            part = part.select(F.lit(variant).alias("variant"), F.lit(split).alias("split"), "label", "n", "width")
            out = part if out is None else out.unionByName(part)
    return out


def examples(t: Tables) -> DataFrame:
    """Embeddings with one class against the rest: row_id, label, features."""
    return t.embeddings.select(
        F.col("vec_id").alias("row_id"),
        (F.col("label") == 3).cast("int").alias("label"),
        array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
    )


def _slug(name: str) -> str:
    return name.lower().replace(" ", "_").replace("-", "_")


def _train_query(name: str) -> None:
    @query(f"train_{_slug(name)}")
    def run(t: Tables) -> DataFrame:
        train, test = train_test_split(examples(t), "label", "row_id")
        return models.board_row(models.train(name, cut_lineage(train)), test).drop("Training Time")


for _name in models.TRAINERS:
    _train_query(_name)


def _searched(t: Tables, name: str) -> tuple[tuning.SearchResult, DataFrame, DataFrame]:
    """The search over the training rows with the operator's own number of candidates and folds; training and test rows.

    All queries share a ledger in the shared folder: the second one on the same rows reads the scores of the first.
    """
    train, test = train_test_split(examples(t), "label", "row_id")
    train = cut_lineage(train)
    return tuning.random_search(name, train, ledger=_ledger(t)), train, test


def _ledger(t: Tables) -> str:
    return f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/tamarack-searches"


def _tuning_queries(name: str) -> None:
    slug = _slug(name)

    @query(f"random_search_{slug}")
    def random_search(t: Tables) -> DataFrame:
        return _searched(t, name)[0].scores

    @query(f"cv_scores_{slug}")
    def cv_scores(t: Tables) -> DataFrame:
        found, train, test = _searched(t, name)
        result = tuning.evaluate_tuned(name, found.best_params, train, test, "BASE", fitted=found.best, ledger=_ledger(t))
        row = (result["model_name"], result["cv_f1_mean"], result["cv_f1_std"], result["test_f1"], result["test_roc_auc"])
        return t.spark.createDataFrame(
            [row], "model_name string, cv_f1_mean double, cv_f1_std double, test_f1 double, test_roc_auc double"
        )

    @query(f"learning_curve_{slug}")
    def learning_curve(t: Tables) -> DataFrame:
        found, train, _ = _searched(t, name)
        return tuning.learning_curve(tuning.BUILDERS[name](found.best_params), train)


@query("soft_vote_ensemble")
def soft_vote_ensemble(t: Tables) -> DataFrame:
    """Test predictions of the three best of the ten models, voting softly; a model that cannot be trained ends the query."""
    train, test = train_test_split(examples(t), "label", "row_id")
    fitted = models.train_all(cut_lineage(train), list(models.TRAINERS)).whole()
    return models.vote_of_best(fitted, models.leaderboard(fitted, test), test)


for _name in tuning.BUILDERS:
    _tuning_queries(_name)

#: Queries of many fits, which belong after all others.
LONG = ["soft_vote_ensemble", *(f"{kind}_{_slug(name)}" for name in tuning.BUILDERS for kind in ("random_search", "cv_scores", "learning_curve"))]
