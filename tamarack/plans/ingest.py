"""From raw reviews and movies to clean tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.functions.dates import parse_date
from tamarack.operators.clean import nan_to_null
from tamarack.operators.ordering import dense_codes, row_index


def clean_reviews(raw: DataFrame, shuffle_seed: int | None = None) -> DataFrame:
    """Drop repeated texts, parse dates, number the rows and code the users.

    Raw reviews carry no row id. The first of several equal texts is the one with the smallest
    (date, user, movie, ...); copies collapse before the shuffle. Texts are unique afterwards,
    so their digests order the row numbers.
    """
    digest = F.sha2(F.coalesce(F.col("review_text"), F.lit("")).cast("binary"), 256)
    dated = raw.withColumns({"review_date": parse_date("review_date"), "_digest": digest})
    order = ["review_date", "user_id", "movie_id"]
    rest = [c for c in raw.columns if c not in (*order, "review_text")]
    row = F.struct(*order, *rest, "review_text")
    first = dated.groupBy("_digest").agg(F.min(row).alias("_row")).select("_digest", "_row.*")
    numbered = row_index(first, "_digest", "review_id").drop("_digest")
    coded = dense_codes(numbered, "user_id", "_user", ["review_id"]).drop("user_id")
    reviews = nan_to_null(coded.withColumnRenamed("_user", "user_id"))
    if shuffle_seed is None:
        return reviews
    return reviews.orderBy(F.xxhash64(F.lit(shuffle_seed), "review_id"))


def clean_movies(raw: DataFrame) -> DataFrame:
    return nan_to_null(raw.withColumn("release_date", parse_date("release_date")))
