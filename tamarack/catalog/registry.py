"""The query registry and the views that give the tables their roles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# Keyword list used on the test tables, whose texts are invented words.
TEST_KEYWORDS = ["that", "is", "the", "tion", "eau", "ung", "er and"]


class Tables:
    """Lazy access to the Parquet tables of one scale factor."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def labelled(self) -> DataFrame:
        return self.documents.join(self.labels, "doc_id")


def query(name: str, sql: str | None = None) -> Callable:
    """Register ``function(tables)`` under ``name``."""

    def register(function: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, folder: function(Tables(spark, folder))
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def rounded(df: DataFrame, digits: int = 6, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


def big(column: str | Column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.cast("bigint")


def reviews_of(t: Tables) -> DataFrame:
    """Documents in the role of reviews: label, date, user, rating and an optional summary."""
    orders = t.orders.select(
        F.col("o_orderkey").alias("doc_id"),
        F.col("o_orderdate").cast("date").alias("review_date"),
        F.col("o_custkey").alias("user_id"),
    )
    summaries = t.conversations.groupBy(F.col("conv_id").alias("doc_id")).agg(
        F.min_by("text", F.struct("turn", "text")).alias("review_summary")
    )
    items = t.benchmark.agg(F.count(F.lit(1))).scalar()
    return (
        t.labelled()
        .join(orders, "doc_id", "left")
        .join(summaries, "doc_id", "left")
        .select(
            F.col("doc_id").alias("review_id"),
            "review_date",
            F.pmod("doc_id", items).cast("string").alias("movie_id"),
            "user_id",
            (F.col("toxic") == 1).alias("is_spoiler"),
            F.col("text").alias("review_text"),
            (F.pmod("n_chars", F.lit(10)) + 1).alias("rating"),
            "review_summary",
        )
    )


def movies_of(t: Tables) -> DataFrame:
    """Benchmark texts in the role of movies, with details from parts and orders."""
    parts = t.part.select(
        F.col("p_partkey").alias("item_id"),
        F.concat((F.col("p_size") / 10).cast("int"), F.lit("h "), F.col("p_size"), F.lit("min")).alias("duration"),
        F.split("p_name", " ").alias("genre"),
        (F.col("p_retailprice") / 100).alias("rating"),
    )
    dates = t.orders.select(F.col("o_orderkey").alias("item_id"), F.col("o_orderdate").cast("date").alias("release_date"))
    synopses = t.conversations.groupBy(F.col("conv_id").alias("item_id")).agg(
        F.max_by("text", F.struct("turn", "text")).alias("plot_synopsis")
    )
    return (
        t.benchmark.join(parts, "item_id", "left")
        .join(dates, "item_id", "left")
        .join(synopses, "item_id", "left")
        .select(
            F.col("item_id").cast("string").alias("movie_id"),
            F.col("text").alias("plot_summary"),
            "duration",
            "genre",
            "rating",
            "release_date",
            "plot_synopsis",
        )
    )
