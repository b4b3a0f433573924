"""Train, compare and tune the classifiers on every data variant."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tamarack.operators.models import (
    TRAINERS,
    Fitted,
    Training,
    best_members,
    best_per_variant,
    combine_boards,
    leaderboard,
    soft_vote,
    train_all,
)
from tamarack.operators.tuning import BUILDERS, evaluate_tuned, learning_curve, random_search
from tamarack.sources.readers import read_split
from tamarack.sources.writers import save_ensemble, save_fitted, write_leaderboard, write_tuning_result


@dataclass
class VariantRun:
    training: Training
    board: DataFrame
    ensemble: DataFrame
    members: list[Fitted]


def run_variant(train: DataFrame, test: DataFrame, names: Sequence[str] = tuple(TRAINERS)) -> VariantRun:
    """Train all models, score them on the test rows, vote with the best three."""
    training = train_all(train, names)
    board = leaderboard(training.fitted, test)
    members = best_members(training.fitted, board)
    return VariantRun(training, board, soft_vote([m.score(test) for m in members]), members)


def compare_variants(
    spark: SparkSession, splits: str, reports: str, variants: Sequence[str] = ("BASE", "SMOTE", "SMOTE_PCA"),
    names: Sequence[str] = tuple(TRAINERS), models: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Leaderboards of all variants and the best model of each, written as CSV.

    With ``models`` set, every trained model and the members of the vote are saved below that folder. Models that failed are
    raised at the end, when all that was trained is written.
    """
    boards, failed = {}, {}
    for variant in variants:
        run = run_variant(read_split(spark, splits, variant, "train"), read_split(spark, splits, variant, "test"), names)
        boards[variant] = run.board
        failed |= {f"{name} ({variant})": reason for name, reason in run.training.failed.items()}
        write_leaderboard(run.board, f"{reports}/{variant.lower()}/model_comparison")
        for fitted in run.training.fitted:
            if models:
                save_fitted(spark, fitted.model, f"{models}/{variant.lower()}/{fitted.name.replace(' ', '_').lower()}_model")
        if models:
            save_ensemble(spark, run.members, f"{models}/{variant.lower()}/ensemble")
    combined = combine_boards(boards)
    write_leaderboard(combined, f"{reports}/all_model_comparison")
    Training(failed=failed).whole()
    return combined, best_per_variant(combined)


def tune(
    spark: SparkSession, name: str, splits: str, reports: str, variants: Sequence[str] = ("BASE", "SMOTE", "SMOTE_PCA"),
    candidates: int = 100, folds: int = 5, models: str | None = None,
) -> dict[str, dict]:
    """Random search, evaluation and learning curve per variant; results go to JSON and CSV, scores of fits to ``<reports>/ledger``.

    A run that was cut short goes on from those scores.

    With ``models`` set, the best model of every variant is saved below that folder.
    """
    results = {}
    for variant in variants:
        train, test = read_split(spark, splits, variant, "train"), read_split(spark, splits, variant, "test")
        ledger = f"{reports}/ledger"
        found = random_search(name, train, candidates, folds, ledger=ledger)
        results[variant] = evaluate_tuned(name, found.best_params, train, test, variant, folds, found.best, ledger)
        slug = f"{name.replace(' ', '_').lower()}_{variant.lower()}"
        write_tuning_result(spark, results[variant], f"{reports}/{slug}")
        write_leaderboard(learning_curve(BUILDERS[name](found.best_params), train, folds=folds), f"{reports}/{slug}_curve")
        if models:
            save_fitted(spark, found.best.model, f"{models}/{slug}")
    return results
