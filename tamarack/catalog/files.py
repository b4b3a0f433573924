"""Round trips through files: every source and sink on the given tables, below the configured shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.catalog.registry import Tables, big, query, rounded
from tamarack.operators.profile import value_counts
from tamarack.plans.explore import pair_sample
from tamarack.plans.ingest import clean_reviews
from tamarack.session import ensure_checkpoint_dir
from tamarack.sources import readers, writers


def _folder(t: Tables) -> str:
    return f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/tamarack-files-{uuid.uuid4().hex}"


def raw_reviews(t: Tables) -> DataFrame:
    """Documents with the columns of raw reviews; every seventh has a rating that is no number."""
    return t.documents.select(
        F.concat(F.pmod("doc_id", F.lit(28)) + 1, F.lit(" January 2015")).alias("review_date"),
        F.concat(F.lit("tt"), F.col("doc_id").cast("string")).alias("movie_id"),
        F.col("source").alias("user_id"),
        (F.col("lang") == "en").alias("is_spoiler"),
        F.col("text").alias("review_text"),
        F.when(F.pmod("doc_id", F.lit(7)) == 0, "n/a").otherwise(F.pmod("n_chars", F.lit(10)).cast("string")).alias("rating"),
        F.col("lang").alias("review_summary"),
    )


REVIEWS_SQL = """SELECT doc_id, 'tt' || doc_id AS movie_id, source AS user_id, lang = 'en' AS is_spoiler, text AS review_text,
    CASE WHEN doc_id % 7 = 0 THEN NULL ELSE n_chars % 10 END AS rating, lang AS review_summary,
    make_date(2015, 1, CAST(doc_id % 28 + 1 AS INT)) AS day FROM documents"""


@query(
    "json_scan",
    f"SELECT movie_id, user_id, is_spoiler, md5(review_text) AS digest, CAST(rating AS BIGINT) AS rating, review_summary FROM ({REVIEWS_SQL})",
)
def json_scan(t: Tables) -> DataFrame:
    """Raw reviews written as JSON lines and scanned with the declared schema."""
    path = _folder(t)
    raw_reviews(t).write.json(path)
    return readers.read_reviews_json(t.spark, path).select(
        "movie_id", "user_id", "is_spoiler", F.md5("review_text").alias("digest"), "rating", "review_summary"
    )


@query(
    "csv_round_trip",
    f"SELECT movie_id, is_spoiler, md5(review_text) AS digest, CAST(rating AS BIGINT) AS rating, CAST(day AS VARCHAR) AS review_date FROM ({REVIEWS_SQL})",
)
def csv_round_trip(t: Tables) -> DataFrame:
    """Reviews through the CSV sink and scan: texts hold quotes, commas and newlines."""
    path = _folder(t)
    rows = raw_reviews(t).withColumns({"rating": F.col("rating").try_cast("bigint"), "user_id": F.lit(1)})
    writers.write_csv(rows.withColumn("review_date", F.date_format(F.to_date("review_date", "d MMMM yyyy"), "yyyy-MM-dd")), path)
    return readers.read_reviews_csv(t.spark, path).select(
        "movie_id", "is_spoiler", F.md5("review_text").alias("digest"), "rating", F.col("review_date").cast("string").alias("review_date")
    )


@query("csv_list_column", "SELECT p_partkey, string_split(p_name, ' ') [1] AS first_word, len(string_split(p_name, ' ')) AS n FROM part")
def csv_list_column(t: Tables) -> DataFrame:
    """A list column written to CSV as a literal and parsed again."""
    path = _folder(t)
    movies = t.part.select(
        F.col("p_partkey").cast("string").alias("movie_id"), F.col("p_name").alias("plot_summary"), F.lit("1h").alias("duration"),
        F.split("p_name", " ").alias("genre"), F.lit(1.0).alias("rating"), F.lit("2015").alias("release_date"), F.lit("x").alias("plot_synopsis"),
    )
    writers.write_csv(movies, path)
    back = readers.read_movies_csv(t.spark, path)
    return back.select(big("movie_id").alias("p_partkey"), F.get("genre", F.lit(0)).alias("first_word"), big(F.size("genre")).alias("n"))


@query("parquet_round_trip", "SELECT doc_id, md5(text) AS digest, source FROM documents")
def parquet_round_trip(t: Tables) -> DataFrame:
    path = _folder(t)
    writers.write_engineered({"reviews": t.documents}, path)
    return readers.read_parquet(t.spark, f"{path}/reviews.parquet").select("doc_id", F.md5("text").alias("digest"), "source")


@query("split_round_trip", "SELECT o_orderkey AS row_id, CAST(o_orderstatus = 'F' AS INT) AS label FROM orders WHERE o_orderkey % 5 = 0")
def split_round_trip(t: Tables) -> DataFrame:
    """Two splits of one variant are written as partitions; the test split is read back, the other folder is not opened."""
    path = _folder(t)
    rows = t.orders.select(F.col("o_orderkey").alias("row_id"), (F.col("o_orderstatus") == "F").cast("int").alias("label"))
    writers.write_split(rows.where("row_id % 5 <> 0"), path, "BASE", "train")
    writers.write_split(rows.where("row_id % 5 = 0"), path, "BASE", "test")
    return readers.read_split(t.spark, path, "BASE", "test")


@query(
    "leaderboard_csv",
    """SELECT o_orderpriority AS "Model", round(avg(CAST(o_orderstatus = 'F' AS INT)), 6) AS "Accuracy", round(avg(o_totalprice) / 1e6, 6) AS "F1-Score"
    FROM orders GROUP BY 1""",
)
def leaderboard_csv(t: Tables) -> DataFrame:
    path = _folder(t)
    share = F.avg((F.col("o_orderstatus") == "F").cast("int"))
    board = t.orders.groupBy(F.col("o_orderpriority").alias("Model")).agg(
        share.alias("Accuracy"), F.lit(0.0).alias("Precision"), F.lit(0.0).alias("Recall"), (F.avg("o_totalprice") / 1e6).alias("F1-Score"),
        F.lit(None).cast("double").alias("AUC-ROC"), F.lit(1.0).alias("Training Time"),
    )
    writers.write_leaderboard(board, path)
    return rounded(readers.read_leaderboard(t.spark, path).select("Model", "Accuracy", "F1-Score"), 6, "Accuracy", "F1-Score")


@query("tuning_json", "SELECT 'Decision Tree' AS model_name, 'BASE' AS data_type, round(avg(o_totalprice), 2) AS cv_f1_mean, CAST(count(*) AS VARCHAR) AS rows FROM orders")
def tuning_json(t: Tables) -> DataFrame:
    path = _folder(t)
    row = t.orders.agg(F.avg("o_totalprice").alias("mean"), F.count(F.lit(1)).alias("n")).first()
    result = {"model_name": "Decision Tree", "data_type": "BASE", "best_params": {"rows": row["n"]}, "cv_f1_mean": float(row["mean"])}
    writers.write_tuning_result(t.spark, result, path)
    back = t.spark.read.schema("model_name string, data_type string, cv_f1_mean double, best_params map<string,string>").json(path)
    return back.select("model_name", "data_type", F.round("cv_f1_mean", 2).alias("cv_f1_mean"), F.col("best_params")["rows"].alias("rows"))


@query(
    "run_metadata",
    """SELECT (SELECT count(*) FROM labels) AS n_rows, 3 AS n_columns, 2 AS n_features,
    (SELECT count(*) FROM labels WHERE toxic = 0) AS clean, (SELECT count(*) FROM labels WHERE toxic = 1) AS toxic""",
)
def run_metadata(t: Tables) -> DataFrame:
    """Shape, features and class counts of a run, written as one row and read back."""
    path = _folder(t)
    row = writers.run_metadata((t.labels.count(), 3), ["quality", "toxic"], 1, 1.0, {"original": value_counts(t.labels, "toxic")}, "toxic")
    writers.write_parquet(row, path)
    classes = F.col("class_distribution_original")
    return readers.read_parquet(t.spark, path).select("n_rows", "n_columns", "n_features", classes[0].alias("clean"), classes[1].alias("toxic"))


@query(
    "clean_reviews",
    f"""WITH r AS ({REVIEWS_SQL}), k AS (SELECT DISTINCT review_text AS t FROM r)
    SELECT count(*) AS n, (SELECT count(*) FROM k) AS texts, 0 AS first_id, count(*) - 1 AS last_id FROM k""",
)
def clean_reviews_shuffled(t: Tables) -> DataFrame:
    """Repeated texts dropped, rows numbered without gaps, the whole put in random order."""
    out = clean_reviews(raw_reviews(t), shuffle_seed=42)
    return out.agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("review_text").alias("texts"), F.min("review_id").cast("int").alias("first_id"),
        F.max("review_id").alias("last_id"),
    )


@query("pair_sample", "SELECT least(count(*), 500) AS n, least(count(*), 500) AS ids FROM documents")
def pair_sample_size(t: Tables) -> DataFrame:
    sample = pair_sample(t.documents, "doc_id", ["n_chars"], "lang", 500)
    return sample.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("ids"))
