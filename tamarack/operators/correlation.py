"""Pearson correlations from one pass, and rankings built on them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.operators.blocks import FAN_IN
from tamarack.session import shuffle_width


def pearson(a: str, b: str) -> Column:
    """Correlation over the rows where both are present; null for a constant column."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    x = F.when(both, F.col(a).cast("double"))
    y = F.when(both, F.col(b).cast("double"))
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def target_correlation(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """(feature, correlation), the target itself left out, strongest positive first."""
    features = [c for c in columns if c != target]
    wide = df.agg(*[pearson(c, target).alias(c) for c in features])
    long = wide.unpivot([], features, "feature", "correlation")
    return long.orderBy(F.desc_nulls_last("correlation"), "feature")


def _block_moments(x: np.ndarray, there: np.ndarray) -> np.ndarray:
    """Pair moments of a block: rows, mean of a, squares of a about it, products, non-finite rows (each columns x columns).

    Cell (a, b) covers the rows in which both are present. Values are taken about the block's medians, which
    leaves constants exact and keeps large offsets from cancelling.
    """
    odd = there & ~np.isfinite(x)
    seen = there & ~odd
    middle = np.array([np.median(c[m]) if m.any() else 0.0 for c, m in zip(x.T, seen.T)])
    z = np.where(seen, x - middle, 0.0)
    m = seen.astype(float)
    rows = m.T @ m
    sums, squares, products = z.T @ m, (z * z).T @ m, z.T @ z
    share = 1.0 / np.maximum(rows, 1.0)
    centred = squares - sums * sums * share
    bad = odd.astype(float).T @ there.astype(float)
    return np.stack(
        [
            rows,
            middle[:, None] + sums * share,
            np.where(centred <= 1e-13 * squares, 0.0, centred),
            products - sums * sums.T * share,
            bad + bad.T,
        ]
    )


def _merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Moments of two sets of rows together (Chan, Golub & LeVeque, 1983), for all pairs at once."""
    rows = a[0] + b[0]
    share = b[0] / np.maximum(rows, 1.0)
    gap = np.where(a[0] * b[0] > 0, b[1] - a[1], 0.0)
    mean = np.where(a[0] == 0, b[1], a[1] + gap * share)
    weight = a[0] * share
    return np.stack([rows, mean, a[2] + b[2] + gap * gap * weight, a[3] + b[3] + gap * gap.T * weight, a[4] + b[4]])


def co_moments(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    """Moments of all pairs of numeric columns in one scan: 5 x columns x columns.

    A task keeps one such array; arrays are merged in a tree, and at most ``FAN_IN`` of them reach the driver.
    """
    columns = list(columns)
    shape = (5, len(columns), len(columns))
    spark = df.sparkSession
    values = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])

    def reduce_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                there = np.stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
                x = np.stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
                total = _merged(total, _block_moments(x, there))
        yield pa.RecordBatch.from_pydict({"m": [total.tobytes()]})

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(shape)
        for raw in pdf["m"]:
            total = _merged(total, np.frombuffer(raw).reshape(shape))
        return pd.DataFrame({"slot": [int(pdf["slot"].iloc[0])], "m": [total.tobytes()]})

    level = values.mapInArrow(reduce_block, "m binary").select(F.spark_partition_id().alias("slot"), "m")
    for width in (max(FAN_IN, shuffle_width(spark)), FAN_IN):
        level = level.withColumn("slot", F.pmod("slot", F.lit(width))).groupBy("slot").applyInPandas(merge, "slot int, m binary")
    total = np.zeros(shape)
    for row in level.select("m").collect():
        total = _merged(total, np.frombuffer(row.m).reshape(shape))
    return total


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, correlation) for every ordered pair of columns, from one scan.

    Over the rows where both are present; null when one of them is constant there or no row has both, NaN when
    such a row holds a value that is not finite. Columns are few enough for columns x columns numbers in a task.
    """
    columns = list(columns)
    rows, _, squares, products, bad = co_moments(df, columns)
    scale = np.sqrt(squares) * np.sqrt(squares.T)
    known = (rows > 0) & (scale > 0)
    values = np.where(known, products / np.where(known, scale, 1.0), 0.0)
    cells = [
        (a, b, float("nan") if bad[i, j] else float(values[i, j]) if known[i, j] else None)
        for i, a in enumerate(columns)
        for j, b in enumerate(columns)
    ]
    return df.sparkSession.createDataFrame(cells, "a string, b string, correlation double")


def rank_features(df: DataFrame, columns: Sequence[str], target: str, limit: int = 30) -> DataFrame:
    """Strongest features by absolute correlation; constant features are left out."""
    ranked = target_correlation(df, columns, target).where(F.col("correlation").isNotNull())
    return (
        ranked.select("feature", F.abs("correlation").alias("importance"))
        .orderBy(F.desc("importance"), "feature")
        .limit(limit)
    )


def top_and_bottom(df: DataFrame, columns: Sequence[str], target: str, each: int = 5) -> DataFrame:
    """The most positive and the most negative features together."""
    known = target_correlation(df, columns, target).where(F.col("correlation").isNotNull())
    top = known.orderBy(F.desc("correlation"), "feature").limit(each)
    bottom = known.orderBy("correlation", "feature").limit(each)
    return top.withColumn("side", F.lit("top")).unionAll(bottom.withColumn("side", F.lit("bottom")))
