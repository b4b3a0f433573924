"""Synthetic minority oversampling (Chawla et al., 2002) to class parity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.operators.joins import skew_join
from tamarack.operators.neighbours import knn
from tamarack.operators.ordering import row_index
from tamarack.operators.splitting import class_counts
from tamarack.session import cut_lineage


def synthetic_rows(
    minority: DataFrame, id_col: str, features: str, needed: int, neighbours: int, seed: int
) -> DataFrame:
    """``needed`` points between a minority row and one of its neighbours.

    Every synthetic row draws its (row, neighbour) pair and its position between them from a
    hash of its own number. Returns synthetic_id, base_id, neighbour_id, share and features.
    """
    spark = minority.sparkSession
    rows = minority.select(F.col(id_col).alias("base_id"), F.col(features).cast("array<double>").alias("_x"))
    total = rows.count()
    near = knn(rows, rows, neighbours, "base_id", "base_id", "_x", skip_self=True).select(
        F.col("query_id").alias("base_id"), "neighbour_id", "rank"
    )
    near = cut_lineage(near)  # the join below reads its left side more than once
    indexed = row_index(rows.select("base_id"), "base_id")
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col("id")), F.lit(total * neighbours))
    draws = spark.range(needed).select(
        F.col("id").alias("synthetic_id"),
        F.floor(draw / neighbours).cast("bigint").alias("row_index"),
        (F.pmod(draw, F.lit(neighbours)) + 1).cast("int").alias("rank"),
        (F.pmod(F.xxhash64(F.lit(seed + 1), F.col("id")), F.lit(1 << 30)) / F.lit(float(1 << 30))).alias("share"),
    )
    paired = draws.join(indexed, "row_index").join(near, ["base_id", "rank"]).join(rows, "base_id")
    others = rows.select(F.col("base_id").alias("neighbour_id"), F.col("_x").alias("_y"))
    both = skew_join(paired, others, ["neighbour_id"], ["synthetic_id"])
    between = F.zip_with("_x", "_y", lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    return both.select(
        "synthetic_id",
        "base_id",
        "neighbour_id",
        "share",
        F.transform(between, lambda p: p["x"] + F.col("share") * (p["y"] - p["x"])).alias(features),
    )


def smote(
    df: DataFrame, id_col: str, features: str, label: str, neighbours: int = 4, seed: int = 42
) -> DataFrame:
    """(id, features, label, is_synthetic) with as many minority as majority rows.

    ``features`` is an array column and ``label`` is 0/1. ``neighbours`` counts real neighbours:
    a neighbour search for 5 that finds the row itself leaves 4. With a minority below two rows
    the data come back unchanged. Synthetic rows get the negative ids -1, -2, ...
    """
    real = df.select(id_col, F.col(features).cast("array<double>").alias(features), label).withColumn(
        "is_synthetic", F.lit(False)
    )
    counts = class_counts(df, label)
    if len(counts) != 2 or min(counts.values()) < 2:
        return real
    small = min(counts, key=lambda c: counts[c])
    needed = max(counts.values()) - counts[small]
    minority = df.where(F.col(label) == F.lit(small))
    made = synthetic_rows(minority, id_col, features, needed, min(neighbours, counts[small] - 1), seed)
    label_type = df.schema[label].dataType
    return real.unionByName(
        made.select(
            (-F.col("synthetic_id") - 1).cast(df.schema[id_col].dataType).alias(id_col),
            features,
            F.lit(small).cast(label_type).alias(label),
            F.lit(True).alias("is_synthetic"),
        )
    )
