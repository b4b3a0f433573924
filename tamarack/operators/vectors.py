"""Term counts, vocabularies and TF-IDF vectors."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, HashingTF, IDF, Normalizer
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.functions.text import exploded_terms, ngrams, vector_words
from tamarack.operators.frequent import frequent_phrases, frequent_terms
from tamarack.session import cut_lineage, shuffle_width, spread

UNIGRAMS = (1,)
TRIGRAMS = (1, 2, 3)

#: Bytes of input up to which all terms are counted in one pass.
DIRECT_BYTES = 1 << 30


def with_terms(df: DataFrame, text: str, sizes: Sequence[int] = UNIGRAMS, output: str = "terms") -> DataFrame:
    """Array column of all n-grams; the words are extracted once."""
    return df.withColumn("_w", vector_words(text)).withColumn(output, ngrams("_w", sizes)).drop("_w")


def term_counts(df: DataFrame, keep: Sequence[str], text: str, sizes: Sequence[int] = UNIGRAMS) -> DataFrame:
    """(keep..., term, tf). ``keep[0]`` is the unique text id.

    The text is spread by id before it is exploded: counting terms of one text then needs no
    further shuffle, and texts are smaller than their exploded terms.
    """
    keep = list(keep)
    spark = df.sparkSession
    slots = max(spark.sparkContext.defaultParallelism, shuffle_width(spark))
    rows = df.select(*keep, text).repartition(slots, keep[0])
    exploded = exploded_terms(with_terms(rows, text, sizes), keep, "terms", "term")
    return exploded.groupBy(*keep, "term").agg(F.count(F.lit(1)).alias("tf"))


def vocabulary(df: DataFrame, text: str, size: int, sizes: Sequence[int] = UNIGRAMS, direct_bytes: int = DIRECT_BYTES) -> DataFrame:
    """The ``size`` most frequent terms of the corpus, ties by term: (term, tf).

    Inputs beyond ``direct_bytes``, by the plan's estimate, have hashed counters first, so that rare terms are never shuffled; the
    rows are the same. Phrases are counted only where all their words are frequent enough.
    """
    texts = df.select(text)
    longest = max(sizes)
    large = int(texts._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) > direct_bytes
    if longest > 1 and sorted(sizes) == list(range(1, longest + 1)):
        return frequent_phrases(spread(texts).select(vector_words(text).alias("words")), size, longest, hashed=large)
    terms = exploded_terms(with_terms(spread(texts), text, sizes), [], "terms", "term")
    if large:
        return frequent_terms(terms, size)
    counts = terms.groupBy("term").agg(F.count(F.lit(1)).alias("tf"))
    return counts.orderBy(F.desc("tf"), "term").limit(size)


@dataclass
class TfidfModel:
    """Fitted vectoriser: counts (by vocabulary or by hash), smooth idf plus one, unit length."""

    text: str
    sizes: Sequence[int]
    counter: CountVectorizerModel | HashingTF
    scale: DenseVector
    terms: list[str] | None

    def weigh(self, counted: DataFrame, output: str = "tfidf") -> DataFrame:
        """From the count column ``_tf`` to unit-length TF-IDF."""
        weighted = ElementwiseProduct(scalingVec=self.scale, inputCol="_tf", outputCol="_weighted").transform(counted)
        return Normalizer(p=2.0, inputCol="_weighted", outputCol=output).transform(weighted).drop("_tf", "_weighted")

    def transform(self, df: DataFrame, output: str = "tfidf") -> DataFrame:
        return self.weigh(counted_terms(spread(df), self.text, self.sizes, self.counter), output)


def counted_terms(df: DataFrame, text: str, sizes: Sequence[int], counter: CountVectorizerModel | HashingTF) -> DataFrame:
    """Add the sparse term counts ``_tf``. Counting happens inside each row on the JVM: no shuffle."""
    return counter.transform(with_terms(df, text, sizes, "_terms")).drop("_terms")


def fit_transform_tfidf(
    df: DataFrame,
    id_col: str,
    text: str,
    max_features: int = 5000,
    sizes: Sequence[int] = TRIGRAMS,
    hashing: bool = False,
) -> tuple[TfidfModel, DataFrame]:
    """Fit TF-IDF and vectorise the same texts: the model and (id, tfidf).

    The counts are written down once; the idf and all later passes read the sparse vectors, not
    the texts. Only the vocabulary (``max_features`` terms) and its idf reach the driver.
    """
    terms = None
    if hashing:
        counter = HashingTF(numFeatures=max_features, inputCol="_terms", outputCol="_tf")
    else:
        terms = sorted(r.term for r in vocabulary(df, text, max_features, sizes).collect())
        counter = CountVectorizerModel.from_vocabulary(terms, inputCol="_terms", outputCol="_tf")
    texts = spread(df.select(id_col, text), id_col)
    counted = cut_lineage(counted_terms(texts, text, sizes, counter).select(id_col, "_tf"))
    idf = IDF(inputCol="_tf", outputCol="_idf").fit(counted).idf
    model = TfidfModel(text, tuple(sizes), counter, DenseVector(idf.toArray() + 1.0), terms)
    return model, model.weigh(counted)


def vector_entries(df: DataFrame, keep: Sequence[str], vector: str) -> DataFrame:
    """(keep..., position, weight): the stored entries of a sparse vector column, one row each."""
    raw = df.select(*keep, F.unwrap_udt(vector).alias("_v"))
    return raw.select(
        *keep,
        F.inline_outer(F.arrays_zip(F.col("_v.indices").alias("position"), F.col("_v.values").alias("weight"))),
    ).where(F.col("position").isNotNull())
