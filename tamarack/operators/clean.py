"""Cleaning: duplicates, missing values, selections and codes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamarack.operators.ordering import dense_codes


def keep_first(df: DataFrame, text: str, order: Sequence[str]) -> DataFrame:
    """One row per distinct text, the first by ``order`` (whose last column must be unique).

    Only a 256-bit digest and the order columns are aggregated; copies collapse before the
    shuffle, so a text that fills a third of the table costs one row per input split.
    """
    order = list(order)
    digest = F.coalesce(F.sha2(F.col(text).cast("binary"), 256), F.lit("null"))
    firsts = (
        df.select(digest.alias("_digest"), *order)
        .groupBy("_digest")
        .agg(F.min(F.struct(*order)).alias("_first"))
        .select(F.col(f"_first.{order[-1]}").alias(order[-1]))
    )
    return df.join(firsts, order[-1], "left_semi")


def fill_missing(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in defaults.items()})


def nan_to_null(df: DataFrame) -> DataFrame:
    """Floating NaN is a missing value here; turn it into null once, at the entrance."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def columns_of_type(df: DataFrame, *types: type[T.DataType]) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, types)]


def columns_with_prefix(df: DataFrame, *prefixes: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefixes)]


def columns_without_prefix(df: DataFrame, *prefixes: str) -> list[str]:
    return [c for c in df.columns if not c.startswith(prefixes)]


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Double and long columns; 32-bit integers stay out, as date parts are no profile columns."""
    return [c for c in columns_of_type(df, T.DoubleType, T.LongType) if c not in exclude]


def label_to_int(df: DataFrame, label: str) -> DataFrame:
    return df.withColumn(label, F.col(label).cast("int"))


def encode_strings(df: DataFrame, id_col: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Replace string (or list) columns by dense lexical codes."""
    columns = columns or [c for c in columns_of_type(df, T.StringType) if c != id_col]
    for column in columns:
        df = dense_codes(df, column, f"_code_{column}", [id_col]).drop(column)
        df = df.withColumnRenamed(f"_code_{column}", column)
    return df
