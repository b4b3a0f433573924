"""The tables behind the exploration reports, before and after feature engineering."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.functions.dates import lag_bin
from tamarack.functions.parsing import duration_lenient
from tamarack.functions.text import whitespace_word_count
from tamarack.operators import correlation, profile
from tamarack.operators.clean import columns_with_prefix, columns_without_prefix, numeric_columns
from tamarack.operators.factors import project_2d

COMPLEXITY = [
    "word_count", "avg_word_length", "num_sentences", "flesch_reading_ease", "flesch_kincaid_grade", "smog_index",
]
SIMILARITY = ["cosine_sim_review_plot", "cosine_sim_summary_synopsis"]

Report = dict[str, Callable[[], DataFrame]]


def initial_report(reviews: DataFrame, movies: DataFrame) -> Report:
    """Name to a function that builds the table; nothing runs until it is called."""
    timed = movies.withColumn("duration_minutes", duration_lenient("duration"))
    sized = reviews.withColumn("review_length", whitespace_word_count("review_text"))
    years = timed.where(F.col("release_date").isNotNull()).withColumn("release_year", F.year("release_date"))
    genres = profile.exploded(movies.select("movie_id", "genre", "rating"), "genre", ["movie_id", "rating"])
    by_genre = profile.mean_and_count(genres, "genre", "rating", min_count=5)
    return {
        "describe_reviews": lambda: profile.describe(sized),
        "describe_movies": lambda: profile.describe(timed.drop("genre")),
        "missing_reviews": lambda: profile.null_profile(reviews),
        "missing_movies": lambda: profile.null_profile(movies),
        "reviews_over_time": lambda: profile.monthly_counts(reviews, "review_date"),
        "reviews_by_day": lambda: profile.weekday_counts(reviews, "review_date"),
        "releases_by_year": lambda: profile.value_counts(years, "release_year").orderBy("release_year"),
        "rating_histogram": lambda: profile.histograms(movies, ["rating"], 20),
        "rating_density": lambda: profile.density(movies, "rating"),
        "review_ratings": lambda: profile.value_counts(reviews, "rating").orderBy("rating"),
        "top_genres": lambda: profile.top_values(genres, "genre", 15),
        "duration_histogram": lambda: profile.histograms(timed, ["duration_minutes"], 30),
        "duration_density": lambda: profile.density(timed, "duration_minutes"),
        "duration_vs_rating": lambda: profile.scatter_bins(timed, "duration_minutes", "rating"),
        "length_histogram": lambda: profile.histograms(sized, ["review_length"], 50),
        "length_up_to_p95": lambda: profile.clip_to_quantile(sized, "review_length").groupBy("review_length").count(),
        "length_by_rating": lambda: profile.box_stats(sized, ["rating"], "review_length"),
        "class_share": lambda: profile.value_shares(reviews, "is_spoiler"),
        "rate_by_rating": lambda: profile.rate_by(reviews, "rating", "is_spoiler"),
        "reviews_per_user": lambda: profile.activity_distribution(reviews, "user_id", 50),
        "top_users": lambda: profile.top_values(reviews, "user_id", 10),
        "rating_by_genre": lambda: by_genre.orderBy(F.desc("mean"), "genre"),
        "movies_by_genre": lambda: by_genre.orderBy(F.desc("count"), "genre"),
    }


def engineered_report(final: DataFrame, id_col: str = "review_id", label: str = "is_spoiler") -> Report:
    df = final.withColumn(label, F.col(label).cast("int"))
    everything = numeric_columns(df, [id_col, label])
    plain = [c for c in everything if c in columns_without_prefix(df, "svd_", "topic_")]
    flags, entities = columns_with_prefix(df, "has_"), columns_with_prefix(df, "entity_")
    topics, svd = columns_with_prefix(df, "topic_"), columns_with_prefix(df, "svd_")
    report: Report = {
        "class_share": lambda: profile.value_shares(df, label),
        "missing": lambda: profile.null_profile(df, missing_only=True),
        "numeric_histograms": lambda: profile.histograms(df, plain),
        "target_correlation": lambda: correlation.target_correlation(df, plain, label),
        "top_positive": lambda: correlation.target_correlation(df, plain, label).limit(10),
        "top_negative": lambda: correlation.target_correlation(df, plain, label)
        .where("correlation is not null").orderBy("correlation", "feature").limit(10),
        "pair_features": lambda: correlation.top_and_bottom(df, plain, label),
        "feature_ranking": lambda: correlation.rank_features(df, everything, label, 30),
    }
    if flags:
        report["keyword_totals"] = lambda: profile.column_sums(df, flags)
        report["keyword_correlation"] = lambda: correlation.target_correlation(df, flags, label)
    if "compound_sentiment_score" in df.columns:
        report["sentiment_histogram"] = lambda: profile.histograms(df, ["compound_sentiment_score"], by=label)
        if "rating_x" in df.columns:
            report["sentiment_by_rating"] = lambda: profile.box_stats(df, ["rating_x"], "compound_sentiment_score")
    if set(COMPLEXITY) <= set(df.columns):
        for column in COMPLEXITY:
            report[f"{column}_by_class"] = lambda c=column: profile.box_stats(df, [label], c)
        report["complexity_correlation"] = lambda: correlation.correlation_matrix(df, [*COMPLEXITY, label])
        if set(SIMILARITY) <= set(df.columns):
            report["similarity_histograms"] = lambda: profile.histograms(df, SIMILARITY, by=label)
            report["similarity_correlation"] = lambda: correlation.correlation_matrix(df, [*COMPLEXITY, *SIMILARITY])
    if svd:
        report["svd_plane"] = lambda: project_2d(df, id_col, svd, label)[0]
    if topics:
        report["topics_by_class"] = lambda: profile.family_means(df, topics, label)
        report["topic_correlation"] = lambda: correlation.target_correlation(df, topics, label)
    if entities:
        report["entity_totals"] = lambda: profile.column_sums(df, entities)
        report["entity_correlation"] = lambda: correlation.target_correlation(df, entities, label)
        report["entities_by_class"] = lambda: profile.family_means(df, entities, label)
    for key in ("review_year", "review_month", "rating_x"):
        if key in df.columns:
            report[f"rate_by_{key}"] = lambda k=key: profile.rate_by(df, k, label)
    if "days_since_release" in df.columns:
        report["rate_by_release_lag"] = lambda: profile.lag_bin_rate(df, "days_since_release", label)
        report["lag_bins"] = lambda: profile.value_counts(df.withColumn("bin", lag_bin("days_since_release")), "bin")
    if "genre" in df.columns:
        report["rate_by_genre"] = lambda: profile.mean_and_count(
            profile.exploded(df, "genre", [label]), "genre", label, min_count=100, scale=100.0
        )
    if "review_length_percentile" in df.columns:
        report["length_percentile_by_class"] = lambda: profile.box_stats(df, [label], "review_length_percentile")
    return report


def pair_sample(final: DataFrame, id_col: str, columns: list[str], label: str, rows: int = 10_000) -> DataFrame:
    """Rows for a pair plot: a fixed-size sample of the chosen columns and the label."""
    return profile.hash_sample(final.select(id_col, *columns, label), id_col, rows)
