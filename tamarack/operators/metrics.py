"""Exact classification metrics from a table of label, prediction and score."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.operators.ordering import running_totals
from tamarack.session import cut_lineage


def _cells(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row with the four counts n<label><prediction>."""
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    return df.agg(
        *[F.count(F.when((y == a) & (p == b), 1)).alias(f"n{a}{b}") for a in (0, 1) for b in (0, 1)]
    )


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(label, prediction, n) for all four cells, empty ones as 0."""
    rows = F.array(
        *[
            F.struct(F.lit(a).alias("label"), F.lit(b).alias("prediction"), F.col(f"n{a}{b}").alias("n"))
            for a in (0, 1)
            for b in (0, 1)
        ]
    )
    return _cells(df, label, prediction).select(F.inline(rows))


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))


def binary_scores(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: accuracy, precision, recall, f1 of class 1 and balanced accuracy."""
    tn, fp, fn, tp = (F.col(f"n{a}{b}") for a in (0, 1) for b in (0, 1))
    recall = _ratio(tp, tp + fn)
    return _cells(df, label, prediction).select(
        _ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        recall.alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        ((recall + _ratio(tn, tn + fp)) / 2).alias("balanced_accuracy"),
    )


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted rows."""
    tn, fp, fn, tp = (F.col(f"n{a}{b}") for a in (0, 1) for b in (0, 1))
    scores = {}
    support = {"0": tn + fp, "1": tp + fn}
    for name, hit, said in (("0", tn, tn + fn), ("1", tp, tp + fp)):
        scores[name] = (_ratio(hit, said), _ratio(hit, support[name]), _ratio(2 * hit, said + support[name]))
    total = tn + fp + fn + tp
    accuracy = _ratio(tn + tp, total)
    pairs = list(zip(scores["0"], scores["1"]))
    rows = [
        ("0", *scores["0"], support["0"]),
        ("1", *scores["1"], support["1"]),
        ("accuracy", accuracy, accuracy, accuracy, total),
        ("macro avg", *[(a + b) / 2 for a, b in pairs], total),
        ("weighted avg", *[_ratio(a * support["0"] + b * support["1"], total) for a, b in pairs], total),
    ]
    names = ("precision", "recall", "f1", "support")
    structs = [F.struct(F.lit(r[0]).alias("row"), *[c.alias(n) for c, n in zip(r[1:], names)]) for r in rows]
    return _cells(df, label, prediction).select(F.inline(F.array(*structs)))


def score_totals(df: DataFrame, label: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score with their totals over lower scores."""
    y = F.col(label).cast("int")
    counts = (
        df.where(F.col(score).isNotNull())
        .groupBy(F.col(score).cast("double").alias("score"))
        .agg(F.sum(F.when(y == 1, 1).otherwise(0)).alias("pos"), F.sum(F.when(y == 0, 1).otherwise(0)).alias("neg"))
    )
    return running_totals(cut_lineage(counts), [], "score", ["pos", "neg"])


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row ``auc``: the Mann-Whitney rank statistic, ties counted half; null for one class."""
    wins = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2.0))
    return score_totals(df, label, score).agg(
        F.try_divide(wins, F.max("pos_total").cast("double") * F.max("neg_total")).alias("auc")
    )


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score, predicting positive at or above it, and (0, 0) at infinity."""
    t = score_totals(df, label, score)
    start = df.sparkSession.createDataFrame([(math.inf, 0.0, 0.0)], "threshold double, fpr double, tpr double")
    curve = t.select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("neg_total") - F.col("neg_before"), F.col("neg_total")).alias("fpr"),
        F.try_divide(F.col("pos_total") - F.col("pos_before"), F.col("pos_total")).alias("tpr"),
    )
    return start.unionByName(curve)


def precision_recall_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """(threshold, precision, recall) for every distinct score, and (1, 0) without a threshold."""
    t = score_totals(df, label, score)
    last = df.sparkSession.createDataFrame([(None, 1.0, 0.0)], "threshold double, precision double, recall double")
    tp = F.col("pos_total") - F.col("pos_before")
    fp = F.col("neg_total") - F.col("neg_before")
    curve = t.select(
        F.col("score").alias("threshold"),
        F.try_divide(tp, tp + fp).alias("precision"),
        F.try_divide(tp, F.col("pos_total")).alias("recall"),
    )
    return curve.unionByName(last)


def average_precision(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row ``average_precision``: recall steps times precision, without interpolation."""
    t = score_totals(df, label, score)
    tp = F.col("pos_total") - F.col("pos_before")
    fp = F.col("neg_total") - F.col("neg_before")
    step = F.try_divide(F.col("pos") * tp.cast("double"), (tp + fp) * F.col("pos_total"))
    return t.agg(F.sum(step).alias("average_precision"))


def scaled_margin(df: DataFrame, margin: str, output: str) -> DataFrame:
    """Margin mapped to 0..1 by its range over the frame."""
    span = df.agg(F.struct(F.min(margin).alias("lo"), F.max(margin).alias("hi"))).scalar()
    ranged = df.withColumn("_span", span)
    return ranged.withColumn(
        output,
        F.try_divide(F.col(margin) - F.col("_span.lo"), F.col("_span.hi") - F.col("_span.lo")),
    ).drop("_span")
