"""Feature vectors, standard scaling and class weights."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.operators.joins import fits
from tamarack.session import cut_lineage


def assemble(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    """One vector column; missing numbers become 0."""
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns}
    return VectorAssembler(inputCols=list(columns), outputCol=output).transform(df.withColumns(filled))


@dataclass
class Scaler:
    """Mean 0 and population standard deviation 1; constant features are only centred."""

    mean: np.ndarray
    std: np.ndarray

    def transform(self, df: DataFrame, vector: str, output: str) -> DataFrame:
        mean = F.array(*[F.lit(float(m)) for m in self.mean])
        std = F.array(*[F.lit(float(s)) for s in self.std])
        centred = F.zip_with(vector_to_array(vector), mean, lambda x, m: x - m)
        return df.withColumn(output, array_to_vector(F.zip_with(centred, std, lambda x, s: x / s)))


def fit_scaler(df: DataFrame, vector: str) -> Scaler:
    """One pass; the driver receives one number pair per feature."""
    row = df.select(
        Summarizer.metrics("mean", "variance", "count").summary(F.col(vector)).alias("s")
    ).select("s.mean", "s.variance", "s.count").first()
    n = row["count"]
    std = np.sqrt(row["variance"].toArray() * ((n - 1) / n if n else 1.0))
    return Scaler(row["mean"].toArray(), np.where(std > 0, std, 1.0))


def standardize_columns(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """The same on plain columns, from one aggregate over ``fit_on`` (default: the frame itself)."""
    source = fit_on if fit_on is not None else df
    stats = source.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]
    ).first()
    scaled = {}
    for c in columns:
        spread = stats[f"s_{c}"] or 1.0
        scaled[c] = (F.col(c) - F.lit(stats[f"m_{c}"])) / F.lit(float(spread))
    return df.withColumns(scaled)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, weight): n / (classes * n_class), so that classes weigh the same in total."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    total, classes = df.agg(F.count(label)).scalar(), counts.agg(F.count(F.lit(1))).scalar()
    return counts.select(label, (total / (classes * F.col("_n"))).alias("weight"))


def balanced(df: DataFrame, label: str, output: str = "weight") -> DataFrame:
    """Add the balanced weight of the row's class, from ``class_weights``; rows without a label get none."""
    weights = class_weights(df, label).withColumnRenamed("weight", output)
    rows = df.drop(output)
    weights = cut_lineage(weights.where(F.col(label).isNotNull()))
    return rows.join(F.broadcast(weights) if fits(weights) else weights, label, "left").select(*rows.columns, output)
