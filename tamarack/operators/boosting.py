"""AdaBoost (SAMME) over shallow Spark decision trees."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.session import cut_lineage, partitions_by_bytes

CHECKPOINT_EVERY = 10

#: Bytes worth a task of their own while slots are free: a round sorts the values of a sample of up to 10,000 rows.
SMALL_BYTES = 2**20


@dataclass
class BoostedModel:
    trees: list[DecisionTreeClassificationModel]
    weights: list[float]

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        """Adds prediction, margin in -1..1 and probability_1; all trees become one expression."""
        total = sum(self.weights) or 1.0
        values = df.withColumn("_a", vector_to_array(features))
        votes = [_vote(tree, "_a") * (w / total) for tree, w in zip(self.trees, self.weights)]
        margin = F.aggregate(F.array(*votes), F.lit(0.0), lambda a, x: a + x) if votes else F.lit(0.0)
        return (
            values.withColumn("margin", margin)
            .drop("_a")
            .withColumns(
                {
                    "prediction": (F.col("margin") > 0).cast("double"),
                    "probability_1": 1 / (1 + F.exp(-2 * F.col("margin"))),
                }
            )
        )


def _vote(tree: DecisionTreeClassificationModel, array: str) -> Column:
    """+1 or -1 per row: the shallow tree written as nested conditions."""

    def branch(node) -> Column:
        if node.getClass().getSimpleName() == "LeafNode":
            return F.lit(1.0 if node.prediction() > 0.5 else -1.0)
        split = node.split()
        goes_left = F.get(array, F.lit(split.featureIndex())) <= split.threshold()
        return F.when(goes_left, branch(node.leftChild())).otherwise(branch(node.rightChild()))

    return branch(tree._java_obj.rootNode())


def _sums(tree: DecisionTreeClassificationModel) -> tuple[float, float]:
    """Weight of the rows a tree gets wrong, and of all rows it was grown on, from the class sums that its leaves hold."""
    wrong = total = 0.0
    nodes = [tree._java_obj.rootNode()]
    while nodes:
        node = nodes.pop()
        if node.getClass().getSimpleName() == "LeafNode":
            by_class = list(node.impurityStats().stats())
            right = by_class[int(node.prediction())]
            wrong, total = wrong + sum(by_class) - right, total + sum(by_class)
        else:
            nodes += [node.rightChild(), node.leftChild()]
    return wrong, total


def _held(df: DataFrame) -> DataFrame:
    """The rows as a written table, in memory, in as many partitions as its bytes deserve: small ones until the slots are full."""
    table = cut_lineage(df)
    slots = df.sparkSession.sparkContext.defaultParallelism
    parts = max(partitions_by_bytes(table), min(slots, partitions_by_bytes(table, SMALL_BYTES)))
    return table.coalesce(parts).persist(StorageLevel.MEMORY_AND_DISK)


def fit_adaboost(
    df: DataFrame,
    label: str = "label",
    features: str = "features",
    rounds: int = 100,
    learning_rate: float = 1.0,
    depth: int = 1,
    seed: int = 42,
) -> BoostedModel:
    """Reweight the rows after every tree; a tree's leaves know the weight of their errors, so that a round is one fit.

    The weight is an expression over the trees grown since the last checkpoint; every few rounds
    it is written down, so that neither the expression nor the lineage grows with the rounds.
    """
    rows = df.select(F.col(label).cast("double").alias("label"), F.col(features).alias("features"))
    held = _held(rows.withColumns({"_a": vector_to_array("features"), "_w": F.lit(1.0)}))
    trees, weights = [], []
    factor = F.lit(1.0)
    for turn in range(rounds):
        current = held.select("label", "features", "_a", (F.col("_w") * factor).alias("_w"))
        learner = DecisionTreeClassifier(
            labelCol="label", featuresCol="features", weightCol="_w", maxDepth=depth, seed=seed + turn
        )
        tree = learner.fit(current)
        miss = (_vote(tree, "_a") > 0).cast("double") != F.col("label")
        wrong, total = _sums(tree)
        error = wrong / total
        if error <= 0:
            trees.append(tree)
            weights.append(1.0)
            break
        if error >= 0.5:
            break
        weight = learning_rate * math.log((1 - error) / error)
        trees.append(tree)
        weights.append(weight)
        factor = factor * F.when(miss, math.exp(weight) / total).otherwise(1.0 / total)
        if (turn + 1) % CHECKPOINT_EVERY == 0:
            written = _held(held.withColumn("_w", F.col("_w") * factor))
            held.unpersist()
            held, factor = written, F.lit(1.0)
    held.unpersist()
    return BoostedModel(trees, weights)
