"""TF-IDF cosine between a text and the text of the item it belongs to."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.operators.joins import hot_from_counts, hot_keys, skew_join
from tamarack.operators.vectors import term_counts
from tamarack.session import cut_lineage, shuffle_width


@dataclass
class PairCosineModel:
    """Item keys, (term, idf, rows of the fitted texts that hold it) and unit item vectors (key, term, weight): all tables."""

    key: str
    keys: DataFrame
    idf: DataFrame
    vectors: DataFrame

    def transform(self, texts: DataFrame, id_col: str, text: str, output: str) -> DataFrame:
        """(id, output) for every row whose key is a known item; terms the model has not seen are left out."""
        paired = texts.join(self.keys, self.key, "left_semi")
        return self.score(paired, cut_lineage(term_counts(paired, [id_col, self.key], text)), id_col, output)

    def score(self, paired: DataFrame, counted: DataFrame, id_col: str, output: str, counts: DataFrame | None = None) -> DataFrame:
        """The same from term counts (id, key, term, tf) that are written already.

        ``counts`` are the (term, rows) of these texts, where they are at hand, to find the frequent terms.
        """
        key = self.key
        parts = shuffle_width(paired.sparkSession)
        hot_items = F.broadcast(hot_keys(paired, [key], parts))
        hot_terms = None if counts is None else hot_from_counts(counts, ["term"], "rows")
        weights = skew_join(counted, self.idf.select("term", "idf"), ["term"], [id_col], hot=hot_terms).select(
            id_col, key, "term", (F.col("tf") * F.col("idf")).alias("_w1")
        )
        salted_texts = weights.join(hot_items, key, "left").withColumn(
            "_salt", F.pmod(F.xxhash64(id_col), F.coalesce("_pieces", F.lit(1))).cast("int")
        )
        salted_items = self.vectors.join(hot_items, key, "left").withColumn(
            "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1))
        )
        matched = salted_texts.drop("_pieces").join(salted_items.drop("_pieces"), [key, "term", "_salt"], "left")
        scores = matched.groupBy(id_col).agg(
            F.try_divide(
                F.sum(F.col("_w1") * F.coalesce("weight", F.lit(0.0))), F.sqrt(F.sum(F.col("_w1") * F.col("_w1")))
            ).alias(output)
        )
        return paired.select(id_col).join(scores, id_col, "left").withColumn(output, F.coalesce(output, F.lit(0.0)))


def _fit(
    texts: DataFrame, items: DataFrame, id_col: str, key: str, text: str, item_text: str
) -> tuple[PairCosineModel, DataFrame, DataFrame]:
    """The model, the rows it was fitted on and their written term counts."""
    item_rows = items.select(key, item_text).where(F.col(key).isNotNull())
    keys = cut_lineage(item_rows.select(key))
    references = cut_lineage(texts.groupBy(key).agg(F.count(F.lit(1)).alias("_refs")).join(keys, key, "left_semi"))
    pair_rows = references.agg(F.sum("_refs")).scalar()
    paired = texts.join(references.select(key), key, "left_semi")
    left = cut_lineage(term_counts(paired, [id_col, key], text))
    right = cut_lineage(term_counts(item_rows, [key], item_text).join(references, key, "left"))

    text_terms = left.groupBy("term").agg(F.count(F.lit(1)).alias("_docs"), F.count(F.lit(1)).alias("rows"))
    item_terms = (
        right.where(F.col("_refs").isNotNull())
        .groupBy("term")
        .agg(F.sum("_refs").alias("_docs"), F.lit(0).cast("bigint").alias("rows"))
    )
    frequency = text_terms.unionAll(item_terms).groupBy("term").agg(F.sum("_docs").alias("_docs"), F.sum("rows").alias("rows"))
    idf = cut_lineage(
        frequency.select("term", (F.log((2 * pair_rows + 1.0) / (F.col("_docs") + 1.0)) + 1.0).alias("idf"), "rows")
    )
    weights = skew_join(right, idf.select("term", "idf"), ["term"], [key]).select(
        key, "term", (F.col("tf") * F.col("idf")).alias("_w2")
    )
    lengths = weights.groupBy(key).agg(F.sqrt(F.sum(F.col("_w2") * F.col("_w2"))).alias("_len2"))
    vectors = cut_lineage(weights.join(lengths, key).select(key, "term", (F.col("_w2") / F.col("_len2")).alias("weight")))
    return PairCosineModel(key, keys, idf, vectors), paired, left


def fit_pair_cosine(texts: DataFrame, items: DataFrame, id_col: str, key: str, text: str, item_text: str) -> PairCosineModel:
    """Idf of the pairs of these texts, and a vector for every item, referred to or not.

    An item's terms that occur in none of the pairs have no idf and are left out. No pairs at all give an empty idf.
    """
    return _fit(texts, items, id_col, key, text, item_text)[0]


def pair_cosine(
    texts: DataFrame,
    items: DataFrame,
    id_col: str,
    key: str,
    text: str,
    item_text: str,
    output: str,
) -> DataFrame:
    """(id, output) for every row of ``texts`` whose key is among ``items``.

    The idf is fitted on both columns of the joined pairs, where an item text counts once per
    text that refers to it. Term counts are written down once and read by every later step. Items are counted once and weighted by their number of references,
    and only the terms a pair shares are multiplied. Frequent terms and items with very many
    texts are cut into pieces for the joins. No shared term, or no term at all, gives 0.
    """
    model, paired, left = _fit(texts, items, id_col, key, text, item_text)
    return model.score(paired, left, id_col, output, model.idf.select("term", "rows"))
