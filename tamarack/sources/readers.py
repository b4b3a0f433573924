"""JSON-lines, CSV, Parquet, split and leaderboard readers."""

from __future__ import annotations

import json
from typing import Any

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamarack.functions.dates import parse_date
from tamarack.functions.parsing import parse_list
from tamarack.operators.boosting import BoostedModel
from tamarack.operators.factors import ReducedModel
from tamarack.operators.models import Fitted, fitted_of
from tamarack.sources import schemas

CSV_OPTIONS = {"header": True, "multiLine": True, "quote": '"', "escape": '"'}


def read_reviews_json(spark: SparkSession, path: str) -> DataFrame:
    """Raw reviews; the rating may be quoted, so it is read as text and converted."""
    raw = spark.read.schema(schemas.RAW_REVIEWS).json(path)
    return raw.withColumn("rating", F.col("rating").try_cast("bigint"))


def read_movies_json(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.schema(schemas.RAW_MOVIES).json(path)
    return raw.withColumn("rating", F.col("rating").try_cast("double"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Texts may hold newlines and quotes. A multi-line file is read by one task: write many files."""
    return spark.read.options(**CSV_OPTIONS).schema(schema).csv(path)


def read_reviews_csv(spark: SparkSession, path: str) -> DataFrame:
    reviews = read_csv(spark, path, schemas.CSV_REVIEWS)
    return reviews.withColumn("review_date", parse_date("review_date"))


def read_movies_csv(spark: SparkSession, path: str) -> DataFrame:
    movies = read_csv(spark, path, schemas.CSV_MOVIES)
    return movies.withColumns({"release_date": parse_date("release_date"), "genre": parse_list("genre")})


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_split(spark: SparkSession, path: str, variant: str, split: str) -> DataFrame:
    """One variant and split; both are partition folders, so the other ones are not opened."""
    table = spark.read.parquet(path)
    return table.where((F.col("variant") == variant.lower()) & (F.col("split") == split)).drop("variant", "split")


def read_leaderboard(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.LEADERBOARD)


def load_model(spark: SparkSession, path: str) -> Any:
    """A saved Spark ML model of any class."""
    return DefaultParamsReader.loadParamsInstance(path, spark)


def load_arrays(spark: SparkSession, kind: type, path: str) -> Any:
    """A model saved by ``save_arrays``; lists of numbers become arrays again."""
    state = json.loads(spark.read.schema("state string").json(path).first()["state"])
    return kind(**{k: np.array(v) if isinstance(v, list) else v for k, v in state.items()})


def load_reduced(spark: SparkSession, path: str) -> ReducedModel:
    """What :func:`~tamarack.sources.writers.save_reduced` wrote."""
    state = json.loads(spark.read.json(f"{path}/shares").first()["state"])
    stages = PipelineModel.load(f"{path}/stages")
    return ReducedModel(stages, np.array(state["ratios"]), state["components"], state["reached"])


def load_boosted(spark: SparkSession, path: str) -> BoostedModel:
    weights = json.loads(spark.read.schema("state string").json(f"{path}/weights").first()["state"])
    return BoostedModel([load_model(spark, f"{path}/tree_{i}") for i in range(len(weights))], weights)


def load_ensemble(spark: SparkSession, path: str) -> list[Fitted]:
    """The members that :func:`~tamarack.sources.writers.save_ensemble` wrote, ready for a soft vote."""
    rows = spark.read.schema("place int, name string, kind string").json(f"{path}/members").orderBy("place").collect()
    loaders = {"boosted": load_boosted, "stage": load_model}
    return [fitted_of(r["name"], loaders[r["kind"]](spark, f"{path}/member_{r['place']}")) for r in rows]


def shape(df: DataFrame) -> tuple[int, int]:
    return df.count(), len(df.columns)


def info(df: DataFrame) -> DataFrame:
    """Column, type and non-null count, from one aggregate."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    types = F.create_map(*[F.lit(x) for f in df.schema for x in (f.name, f.dataType.simpleString())])
    long = counts.unpivot([], df.columns, "column_name", "non_null")
    return long.withColumn("data_type", types[F.col("column_name")])
