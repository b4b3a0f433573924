"""Stratified splits and folds, exact in size and repeatable."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.operators.ordering import pick_by_hash, running_totals
from tamarack.session import cut_lineage


def class_counts(df: DataFrame, label: str) -> dict:
    """Rows per class, for labels that are known to have a handful of values."""
    return {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(label).collect()}


def largest_remainder(counts: DataFrame, label: str, size: int) -> DataFrame:
    """(label, quota): ``size`` rows shared over the classes of (label, n) in proportion, leftovers to the largest remainders.

    Null is a class of its own. The number of classes is not bounded.
    """
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    exact = F.col("n") * F.lit(size) / F.lit(float(max(total, 1)))
    shares = cut_lineage(counts.select(label, F.floor(exact).cast("bigint").alias("quota"), (exact - F.floor(exact)).alias("_rest")))
    spare = size - (shares.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0])
    first = shares.orderBy(F.desc("_rest"), F.col(label).cast("string")).limit(max(0, int(spare))).select(label, F.lit(1).alias("quota"))
    return shares.select(label, "quota").unionByName(first).groupBy(label).agg(F.sum("quota").alias("quota"))


def stratified_pick(df: DataFrame, label: str, id_col: str, size: int, seed: int = 42) -> DataFrame:
    """Mark exactly ``size`` rows, class shares kept: adds boolean ``picked``."""
    quotas = largest_remainder(df.groupBy(label).agg(F.count(F.lit(1)).alias("n")), label, size)
    return pick_by_hash(df, [label], cut_lineage(quotas), id_col, seed)


def train_test_split(
    df: DataFrame, label: str, id_col: str, test_share: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Stratified train and test frames; test has ceil(share * rows) rows."""
    total = df.count()
    marked = stratified_pick(df, label, id_col, math.ceil(test_share * total), seed)
    return marked.where(~F.col("picked")).drop("picked"), marked.where("picked").drop("picked")


def with_split(df: DataFrame, label: str, id_col: str, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """The same as one frame with a ``split`` column."""
    total = df.count()
    marked = stratified_pick(df, label, id_col, math.ceil(test_share * total), seed)
    return marked.withColumn("split", F.when(F.col("picked"), "test").otherwise("train")).drop("picked")


def with_folds(df: DataFrame, label: str, id_col: str, folds: int = 5, seed: int = 42) -> DataFrame:
    """A ``fold`` column: the rows of each class, in hash order, are dealt to the folds in turn."""
    keyed = df.select(id_col, label, F.xxhash64(F.lit(seed), id_col).alias("_hash"), F.lit(1).cast("bigint").alias("_one"))
    placed = running_totals(cut_lineage(keyed), [label], "_hash", ["_one"])  # ids only: no feature vector is moved
    dealt = placed.select(id_col, F.pmod("_one_before", F.lit(folds)).cast("int").alias("fold"))
    return df.join(dealt, id_col)
