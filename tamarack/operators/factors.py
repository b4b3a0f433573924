"""Truncated SVD, topics and principal components."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import LDA, LDAModel
from pyspark.ml.feature import PCA, StandardScaler, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.operators.blocks import sum_blocks
from tamarack.operators.profile import hash_sample
from tamarack.operators.scaling import fit_scaler
from tamarack.session import cut_lineage

BLOCK_ROWS = 256


def _sparse_rows(df: DataFrame, vector: str, *keep: str) -> DataFrame:
    raw = df.select(*keep, F.unwrap_udt(vector).alias("_v"))
    return raw.select(*keep, F.col("_v.indices").alias("_i"), F.col("_v.values").alias("_x"))


def _dense_block(indices: list, values: list, width: int) -> np.ndarray:
    block = np.zeros((len(indices), width))
    rows = np.repeat(np.arange(len(indices)), [len(i) for i in indices])
    if len(rows):
        block[rows, np.concatenate(indices)] = np.concatenate(values)
    return block


def _blocks(pdf: pd.DataFrame, width: int) -> Iterator[tuple[slice, np.ndarray]]:
    indices, values = list(pdf["_i"]), list(pdf["_x"])
    for start in range(0, len(pdf), BLOCK_ROWS):
        part = slice(start, min(start + BLOCK_ROWS, len(pdf)))
        yield part, _dense_block(indices[part], values[part], width)


@dataclass
class SvdModel:
    """Right singular vectors (features x components) and singular values; no centring."""

    components: np.ndarray
    singular_values: np.ndarray

    def transform(self, df: DataFrame, id_col: str, vector: str, prefix: str = "svd_") -> DataFrame:
        """(id, svd_0, svd_1, ...): each row times the components."""
        matrix = self.components
        width, k = matrix.shape
        spark = df.sparkSession
        shared = spark.sparkContext.broadcast(matrix)

        def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                out = np.zeros((len(pdf), k))
                for part, block in _blocks(pdf, width):
                    out[part] = block @ shared.value
                yield pd.DataFrame({id_col: pdf[id_col], "_p": list(out)})

        id_type = df.schema[id_col].dataType.simpleString()
        rows = _sparse_rows(df, vector, id_col).mapInPandas(project, f"`{id_col}` {id_type}, _p array<double>")
        return rows.select(id_col, *[F.get("_p", F.lit(i)).alias(f"{prefix}{i}") for i in range(k)])


def fit_svd(
    df: DataFrame, vector: str, width: int, k: int = 100, power_iterations: int = 5, oversample: int = 10, seed: int = 42
) -> SvdModel:
    """Randomised truncated SVD (Halko, Martinsson & Tropp, 2011).

    Every pass multiplies the data by a width x (k + oversample) matrix inside the tasks and
    adds the results in a tree; what reaches the driver has that fixed size. The number of
    passes is fixed too, unlike an iterative eigen solver. The rows are read from a written table: a task reads one split of it,
    whatever the number of rows.
    """
    k = min(k, width)
    size = min(width, k + oversample)
    rows = cut_lineage(_sparse_rows(df, vector))
    splits = rows.rdd.getNumPartitions()
    spark = df.sparkSession

    def gram_times(basis: np.ndarray) -> np.ndarray:
        shared = spark.sparkContext.broadcast(basis)

        def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros((width, size))
            for pdf in batches:
                for _, block in _blocks(pdf, width):
                    total += block.T @ (block @ shared.value)
            yield pd.DataFrame({"m": [total.tobytes()]})

        return sum_blocks(rows.mapInPandas(multiply, "m binary"), splits, (width, size))

    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, size)))[0]
    for _ in range(power_iterations):
        basis = np.linalg.qr(gram_times(basis))[0]
    small = basis.T @ gram_times(basis)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(values)[::-1][:k]
    components = basis @ vectors[:, order]
    signs = np.sign(components[np.abs(components).argmax(axis=0), np.arange(k)])
    return SvdModel(components * np.where(signs == 0, 1, signs), np.sqrt(np.clip(values[order], 0, None)))


def fit_topics(
    df: DataFrame, vector: str, topics: int = 10, passes: int = 10, seed: int = 42, batches: int = 4
) -> LDAModel:
    """Online variational LDA on TF-IDF weights by mini-batches with decaying steps.

    Each of the ``passes * batches`` updates sees a seeded draw of one in ``batches`` texts, so that the topics move
    while the corpus is read and not only after each pass. A draw without texts changes nothing.
    """
    lda = LDA(
        featuresCol=vector,
        k=topics,
        optimizer="online",
        maxIter=passes * batches,
        learningOffset=50.0,
        learningDecay=0.7,
        subsamplingRate=1.0 / batches,
        optimizeDocConcentration=False,
        seed=seed,
    )
    cached = df.select(vector).persist(StorageLevel.MEMORY_AND_DISK)
    model = lda.fit(cached)
    cached.unpersist()
    return model


def topic_features(model: LDAModel, df: DataFrame, id_col: str, prefix: str = "topic_") -> DataFrame:
    """(id, topic_0, topic_1, ...): topic weights of a text, summing to 1."""
    k = model.getK()
    spread_out = model.transform(df).select(id_col, vector_to_array("topicDistribution").alias("_t"))
    total = F.aggregate("_t", F.lit(0.0), lambda a, x: a + x)
    share = F.transform("_t", lambda x: F.when(total > 0, x / total).otherwise(1.0 / k))
    spread_out = spread_out.withColumn("_t", share)
    return spread_out.select(id_col, *[F.get("_t", F.lit(i)).alias(f"{prefix}{i}") for i in range(k)])


@dataclass
class ReducedModel:
    """Centring, projection and the slice of components that explain the wanted variance."""

    stages: PipelineModel
    ratios: np.ndarray
    components: int
    reached: bool

    def transform(self, df: DataFrame) -> DataFrame:
        return self.stages.transform(df)


def fit_pca(
    df: DataFrame, vector: str, output: str, variance: float = 0.95, max_components: int = 125
) -> ReducedModel:
    """Fit once, keep the first components that explain ``variance``.

    When the allowed components never reach it, all of them are kept and ``reached`` is False.
    """
    width = len(df.select(vector).first()[0])
    k = min(max_components, width)
    centre = StandardScaler(withMean=True, withStd=False, inputCol=vector, outputCol="_centred").fit(df)
    pca = PCA(k=k, inputCol="_centred", outputCol="_projected").fit(centre.transform(df))
    ratios = pca.explainedVariance.toArray()
    enough = np.nonzero(np.cumsum(ratios) >= variance)[0]
    components = int(enough[0]) + 1 if len(enough) else k
    cut = VectorSlicer(inputCol="_projected", outputCol=output, indices=list(range(components)))
    return ReducedModel(PipelineModel([centre, pca, cut]), ratios, components, bool(len(enough)))


def project_2d(df: DataFrame, id_col: str, columns: list[str], label: str, rows: int = 20_000, seed: int = 42) -> tuple[DataFrame, np.ndarray]:
    """Standardised 2-D projection of a repeatable sample, with the two explained-variance shares."""
    sample = hash_sample(df.select(id_col, label, *columns), id_col, rows, seed).withColumn(
        "_v", array_to_vector(F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns]))
    )
    scaled = fit_scaler(sample, "_v").transform(sample, "_v", "_scaled")
    pca = PCA(k=2, inputCol="_scaled", outputCol="_p").fit(scaled)
    points = pca.transform(scaled).withColumn("_p", vector_to_array("_p"))
    return (
        points.select(id_col, F.get("_p", F.lit(0)).alias("pca_1"), F.get("_p", F.lit(1)).alias("pca_2"), label),
        pca.explainedVariance.toArray(),
    )
