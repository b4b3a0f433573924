"""The binary scores as a Spark ML evaluator, for Spark's own validators."""

from __future__ import annotations

from typing import Any

from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tamarack.operators.metrics import binary_scores, roc_auc

METRICS = ("f1", "accuracy", "precision", "recall", "balanced_accuracy", "auc")


class BinaryScorer(Evaluator, DefaultParamsReadable, DefaultParamsWritable):
    """``metricName`` is one of :data:`METRICS`; F1 is that of class 1. Rows without a label do not count.

    ``auc`` ranks by ``scoreCol``: a number, or a vector whose second entry belongs to class 1. No rows give 0.
    """

    metricName = Param(Params._dummy(), "metricName", "score to compute", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "0/1 label", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "0/1 prediction", TypeConverters.toString)
    scoreCol = Param(Params._dummy(), "scoreCol", "ranking score", TypeConverters.toString)

    def __init__(self, **params: Any) -> None:
        super().__init__()
        self._setDefault(metricName="f1", labelCol="label", predictionCol="prediction", scoreCol="probability")
        self._set(**params)

    def _evaluate(self, dataset: DataFrame) -> float:
        metric, label = self.getOrDefault("metricName"), self.getOrDefault("labelCol")
        if metric not in METRICS:
            raise ValueError(f"{metric} is none of {', '.join(METRICS)}")
        known = dataset.where(F.col(label).isNotNull())
        if metric != "auc":
            return float(binary_scores(known, label, self.getOrDefault("predictionCol")).first()[metric])
        name = self.getOrDefault("scoreCol")
        plain = isinstance(dataset.schema[name].dataType, NumericType)
        score = F.col(name) if plain else vector_to_array(name)[1]
        found = roc_auc(known.select(F.col(label).alias("label"), score.alias("score")), "label", "score").first()["auc"]
        return float(found) if found is not None else 0.0

    def isLargerBetter(self) -> bool:
        return True
