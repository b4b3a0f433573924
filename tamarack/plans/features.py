"""All features of a review table joined with its movies."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.functions.constants import ENTITY_TYPES, KEYWORDS
from tamarack.functions.dates import days_between, with_date_parts
from tamarack.functions.parsing import duration_strict
from tamarack.functions.text import with_keyword_flags, with_readability, with_token_stats
from tamarack.operators.factors import fit_svd, fit_topics, topic_features
from tamarack.operators.joins import lookup_join
from tamarack.operators.lexicon import with_entity_counts, with_sentiment
from tamarack.operators.selection import percentile_rank
from tamarack.operators.profile import group_stats
from tamarack.operators.similarity import pair_cosine
from tamarack.operators.vectors import TRIGRAMS, UNIGRAMS, fit_transform_tfidf
from tamarack.session import cut_lineage

ID = "review_id"


@dataclass
class FeatureConfig:
    """Word lists are user data; sizes default to the published run."""

    lexicon: DataFrame | None = None
    gazetteer: DataFrame | None = None
    boosters: Sequence[str] = ()
    dampeners: Sequence[str] = ()
    negations: Sequence[str] = ()
    keywords: Sequence[str] = field(default_factory=lambda: list(KEYWORDS))
    max_features: int = 5000
    components: int = 100
    hashing: bool = True
    topics: int = 10


def with_review_features(reviews: DataFrame, config: FeatureConfig) -> DataFrame:
    """Token statistics, sentiment, keyword flags and date parts of the review itself."""
    out = with_token_stats(reviews, "review_text")
    if config.lexicon is not None:
        out = with_sentiment(
            out, ID, "review_text", config.lexicon, config.boosters, config.dampeners, config.negations
        )
    else:
        out = out.withColumn("compound_sentiment_score", F.lit(0.0))
    return with_date_parts(with_keyword_flags(out, "review_text", config.keywords), "review_date")


def with_movie_features(reviews: DataFrame, movies: DataFrame, rated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(merged, with statistics): inner join with the movies, then rating statistics per movie.

    The statistics come from ``rated``, all reviews before the join drops those without a movie.
    ``merged`` is a hand-off table and the start of every later family: it is written down once.
    """
    timed = movies.withColumn("duration_minutes", duration_strict("duration"))
    merged = cut_lineage(
        lookup_join(
            reviews.withColumnRenamed("rating", "rating_x"),
            timed.withColumnRenamed("rating", "rating_y"),
            ["movie_id"],
            [ID],
        )
    )
    stats = group_stats(rated, ["movie_id"], "rating", "rating")
    joined = lookup_join(merged, stats, ["movie_id"], [ID], "left")
    ranked = percentile_rank(joined, ["movie_id"], "word_count", "review_length_percentile", [ID])
    return merged, ranked.withColumn("days_since_release", days_between("review_date", "release_date"))


def vector_features(rows: DataFrame, config: FeatureConfig) -> list[DataFrame]:
    """SVD columns of the n-gram TF-IDF, and topic columns of the unigram TF-IDF, by review id."""
    texts = rows.select(ID, "review_text")
    tfidf, vectors = fit_transform_tfidf(texts, ID, "review_text", config.max_features, TRIGRAMS, config.hashing)
    svd = fit_svd(vectors, "tfidf", tfidf.scale.size, config.components)
    _, words = fit_transform_tfidf(texts, ID, "review_text", config.max_features, UNIGRAMS)
    topics = fit_topics(words, "tfidf", config.topics)
    return [svd.transform(vectors, ID, "tfidf"), topic_features(topics, words, ID)]


def build_features(reviews: DataFrame, movies: DataFrame, config: FeatureConfig) -> dict[str, DataFrame]:
    """The four hand-off tables: reviews_engineered, movies_engineered, merged, final_engineered.

    Every feature family is a narrow frame keyed by review id. The wide rows are partitioned by
    that key once and all families join onto the same partitioning.
    """
    own = with_review_features(reviews, config)
    merged, final = with_movie_features(own, movies, reviews)
    texts = merged.select(ID, "review_text")
    families = [with_readability(texts, "review_text").drop("review_text")]
    if config.gazetteer is not None:
        families.append(with_entity_counts(texts, ID, "review_text", config.gazetteer).drop("review_text"))
    else:
        families.append(texts.select(ID, *[F.lit(0).alias(f"entity_{t}") for t in ENTITY_TYPES]))
    plots = movies.select("movie_id", "plot_summary", "plot_synopsis")
    families.append(
        pair_cosine(
            merged.select(ID, "movie_id", "review_text"), plots, ID, "movie_id",
            "review_text", "plot_summary", "cosine_sim_review_plot",
        )
    )
    families.append(
        pair_cosine(
            merged.select(ID, "movie_id", "review_summary"), plots, ID, "movie_id",
            "review_summary", "plot_synopsis", "cosine_sim_summary_synopsis",
        )
    )
    families += vector_features(merged, config)
    for family in families:
        final = final.join(family, ID)
    return {
        "reviews_engineered": own,
        "movies_engineered": movies.withColumn("duration_minutes", duration_strict("duration")),
        "merged": merged,
        "final_engineered": final,
    }
