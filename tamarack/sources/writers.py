"""CSV, Parquet, split, leaderboard, tuning-result and model writers."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import fields, is_dataclass

import numpy as np
from pyspark.ml import Model, Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamarack.operators.boosting import BoostedModel
from tamarack.operators.factors import ReducedModel
from tamarack.operators.models import Fitted
from tamarack.sources.readers import CSV_OPTIONS


def write_csv(df: DataFrame, path: str) -> None:
    """List columns become list literals, as CSV cells hold text only."""
    lists = {
        f.name: F.to_json(f.name) for f in df.schema if isinstance(f.dataType, T.ArrayType)
    }
    out = df.withColumns(lists) if lists else df
    options = {k: v for k, v in CSV_OPTIONS.items() if k != "multiLine"}
    out.write.mode("overwrite").options(**options).csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_engineered(tables: Mapping[str, DataFrame], folder: str) -> None:
    """The four hand-off tables: reviews, movies, merged and final features."""
    for name, table in tables.items():
        write_parquet(table, f"{folder}/{name}.parquet")


def write_split(df: DataFrame, path: str, variant: str, split: str) -> None:
    """Only the given variant and split folder is replaced."""
    (
        df.withColumns({"variant": F.lit(variant.lower()), "split": F.lit(split)})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("variant", "split")
        .parquet(path)
    )


def write_leaderboard(board: DataFrame, path: str) -> None:
    write_csv(board.coalesce(1), path)


def write_tuning_result(spark: SparkSession, result: Mapping[str, object], path: str) -> None:
    """One JSON line with model, variant, best parameters and scores."""
    row = {k: v for k, v in result.items() if k != "best_params"}
    row["best_params"] = {k: str(v) for k, v in dict(result["best_params"]).items()}
    schema = T.StructType(
        [
            T.StructField("model_name", T.StringType()),
            T.StructField("data_type", T.StringType()),
            T.StructField("best_params", T.MapType(T.StringType(), T.StringType())),
            T.StructField("cv_f1_mean", T.DoubleType()),
            T.StructField("cv_f1_std", T.DoubleType()),
            T.StructField("test_f1", T.DoubleType()),
            T.StructField("test_roc_auc", T.DoubleType()),
        ]
    )
    spark.createDataFrame([tuple(row.get(f.name) for f in schema)], schema).coalesce(1).write.mode(
        "overwrite"
    ).json(path)


def save_model(model: Model | Transformer, path: str) -> None:
    model.write().overwrite().save(path)


def save_arrays(spark: SparkSession, model: object, path: str) -> None:
    """Save a model that is a dataclass of arrays, numbers and texts as one JSON row."""
    state = {f.name: getattr(model, f.name) for f in fields(model)}
    plain = {k: v.tolist() if isinstance(v, np.ndarray) else v for k, v in state.items()}
    spark.createDataFrame([(json.dumps(plain),)], "state string").coalesce(1).write.mode("overwrite").json(path)


def save_boosted(spark: SparkSession, model: BoostedModel, path: str) -> None:
    """Every tree as a Spark model, and one row with their weights."""
    for i, tree in enumerate(model.trees):
        save_model(tree, f"{path}/tree_{i}")
    row = [(json.dumps(model.weights),)]
    spark.createDataFrame(row, "state string").coalesce(1).write.mode("overwrite").json(f"{path}/weights")


def save_reduced(spark: SparkSession, model: ReducedModel, path: str) -> None:
    """The fitted stages of a PCA as a Spark pipeline, and one row with its explained shares."""
    save_model(model.stages, f"{path}/stages")
    state = {"ratios": model.ratios.tolist(), "components": model.components, "reached": model.reached}
    spark.createDataFrame([(json.dumps(state),)], "state string").coalesce(1).write.mode("overwrite").json(f"{path}/shares")


def save_fitted(spark: SparkSession, model: object, path: str) -> bool:
    """Save any trained classifier or PCA; False for one without a model of its own."""
    if isinstance(model, BoostedModel):
        save_boosted(spark, model, path)
    elif isinstance(model, ReducedModel):
        save_reduced(spark, model, path)
    elif isinstance(model, (Model, Transformer)):
        save_model(model, path)
    elif is_dataclass(model):
        save_arrays(spark, model, path)
    else:
        return False
    return True


def save_ensemble(spark: SparkSession, members: Sequence[Fitted], path: str) -> None:
    """The members of a soft vote, each as its own model, and a row per member with its name and kind."""
    rows = []
    for i, member in enumerate(members):
        save_fitted(spark, member.model, f"{path}/member_{i}")
        rows.append((i, member.name, "boosted" if isinstance(member.model, BoostedModel) else "stage"))
    table = spark.createDataFrame(rows, "place int, name string, kind string")
    table.coalesce(1).write.mode("overwrite").json(f"{path}/members")


def run_metadata(
    shape: tuple[int, int],
    feature_names: list[str],
    components: int,
    explained: float,
    class_counts: Mapping[str, DataFrame],
    label: str,
) -> DataFrame:
    """One row: shape, features, components and a class-count map per stage."""
    spark = next(iter(class_counts.values())).sparkSession
    base = spark.createDataFrame(
        [(shape[0], shape[1], len(feature_names), feature_names, components, float(explained))],
        "n_rows bigint, n_columns int, n_features int, feature_names array<string>, "
        "pca_components int, explained_variance double",
    )
    for stage, counts in class_counts.items():
        pairs = counts.agg(
            F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(label).cast("int"), "n"))))
        ).scalar()
        base = base.withColumn(f"class_distribution_{stage}", pairs)
    return base
