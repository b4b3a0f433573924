"""Declared schemas; nothing is inferred from data."""

from pyspark.sql import types as T

RAW_REVIEWS = T.StructType(
    [
        T.StructField("review_date", T.StringType()),
        T.StructField("movie_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("is_spoiler", T.BooleanType()),
        T.StructField("review_text", T.StringType()),
        T.StructField("rating", T.StringType()),
        T.StructField("review_summary", T.StringType()),
    ]
)

RAW_MOVIES = T.StructType(
    [
        T.StructField("movie_id", T.StringType()),
        T.StructField("plot_summary", T.StringType()),
        T.StructField("duration", T.StringType()),
        T.StructField("genre", T.ArrayType(T.StringType())),
        T.StructField("rating", T.StringType()),
        T.StructField("release_date", T.StringType()),
        T.StructField("plot_synopsis", T.StringType()),
    ]
)

CSV_REVIEWS = T.StructType(
    [
        T.StructField("review_date", T.StringType()),
        T.StructField("movie_id", T.StringType()),
        T.StructField("user_id", T.IntegerType()),
        T.StructField("is_spoiler", T.BooleanType()),
        T.StructField("review_text", T.StringType()),
        T.StructField("rating", T.LongType()),
        T.StructField("review_summary", T.StringType()),
    ]
)

CSV_MOVIES = T.StructType(
    [
        T.StructField("movie_id", T.StringType()),
        T.StructField("plot_summary", T.StringType()),
        T.StructField("duration", T.StringType()),
        T.StructField("genre", T.StringType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("release_date", T.StringType()),
        T.StructField("plot_synopsis", T.StringType()),
    ]
)

LEADERBOARD = T.StructType(
    [
        T.StructField("Model", T.StringType()),
        T.StructField("Accuracy", T.DoubleType()),
        T.StructField("Precision", T.DoubleType()),
        T.StructField("Recall", T.DoubleType()),
        T.StructField("F1-Score", T.DoubleType()),
        T.StructField("AUC-ROC", T.DoubleType()),
        T.StructField("Training Time", T.DoubleType()),
    ]
)
