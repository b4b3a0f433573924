"""The feature families as Spark ML stages: Params, fit and transform, saved and loaded with a ``pyspark.ml.Pipeline``."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

import numpy as np
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame

from tamarack.functions.constants import ENTITY_TYPES, KEYWORDS
from tamarack.functions.dates import with_date_parts
from tamarack.functions.text import with_keyword_flags, with_readability, with_token_stats
from tamarack.operators.factors import SvdModel, fit_svd, fit_topics, topic_features
from tamarack.operators.lexicon import with_entity_counts, with_sentiment
from tamarack.operators.similarity import PairCosineModel, fit_pair_cosine
from tamarack.operators.vectors import TRIGRAMS, UNIGRAMS, TfidfModel, fit_transform_tfidf
from tamarack.sources.persisted import Persisted


def _text(name: str, doc: str) -> Param:
    return Param(Params._dummy(), name, doc, TypeConverters.toString)


def _texts(name: str, doc: str) -> Param:
    return Param(Params._dummy(), name, doc, TypeConverters.toListString)


def _whole(name: str, doc: str) -> Param:
    return Param(Params._dummy(), name, doc, TypeConverters.toInt)


def _flag(name: str, doc: str) -> Param:
    return Param(Params._dummy(), name, doc, TypeConverters.toBoolean)


class Stage(Params, Persisted):
    """Params by keyword; ``parts`` holds the tables and models a stage works with."""

    def __init__(self, parts: dict[str, Any] | None = None, **params: Any) -> None:
        super().__init__()
        self.parts = dict(parts or {})
        self._set(**params)

    def value(self, name: str) -> Any:
        return self.getOrDefault(name)

    def _fitted(self, kind: type, parts: dict[str, Any]) -> Any:
        """A model of ``kind`` with this estimator's Params."""
        return self._copyValues(kind(parts))


class TextColumns(Stage):
    idCol = _text("idCol", "unique id of a row")
    textCol = _text("textCol", "text column")


class TextStatistics(TextColumns, Transformer):
    """Token statistics, keyword flags and, with a part ``lexicon`` (term, valence), the compound sentiment."""

    keywords = _texts("keywords", "words and phrases to flag")
    boosters = _texts("boosters", "words that strengthen")
    dampeners = _texts("dampeners", "words that weaken")
    negations = _texts("negations", "words that negate")
    outputCol = _text("outputCol", "sentiment column")

    def __init__(self, parts: dict[str, Any] | None = None, **params: Any) -> None:
        super().__init__(parts)
        self._setDefault(
            keywords=list(KEYWORDS), boosters=[], dampeners=[], negations=[], outputCol="compound_sentiment_score"
        )
        self._set(**params)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        id_col, text = self.value("idCol"), self.value("textCol")
        out = with_keyword_flags(with_token_stats(dataset, text), text, self.value("keywords"))
        if "lexicon" not in self.parts:
            return out
        words = (self.value(n) for n in ("boosters", "dampeners", "negations"))
        return with_sentiment(out, id_col, text, self.parts["lexicon"], *words, self.value("outputCol"))


class EntityCounts(TextColumns, Transformer):
    """Counts per entity type; part ``gazetteer``: (surface, entity_type)."""

    types = _texts("types", "entity types to count")

    def __init__(self, parts: dict[str, Any] | None = None, **params: Any) -> None:
        super().__init__(parts)
        self._setDefault(types=list(ENTITY_TYPES))
        self._set(**params)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return with_entity_counts(dataset, self.value("idCol"), self.value("textCol"), self.parts["gazetteer"], self.value("types"))


class Readability(TextColumns, Transformer):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        return with_readability(dataset, self.value("textCol"))


class DateParts(Stage, Transformer):
    dateCol = _text("dateCol", "date column")
    prefix = _text("prefix", "prefix of the new columns")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return with_date_parts(dataset, self.value("dateCol"), self.value("prefix"))


class Vectorised(TextColumns):
    """Shared by the stages that work on TF-IDF vectors."""

    maxFeatures = _whole("maxFeatures", "vocabulary size or number of buckets")
    ngrams = _flag("ngrams", "one to three words instead of single words")
    hashing = _flag("hashing", "hash buckets instead of a vocabulary")

    def _learn(self, dataset: DataFrame) -> tuple[TfidfModel, DataFrame]:
        sizes = TRIGRAMS if self.value("ngrams") else UNIGRAMS
        size = self.value("maxFeatures")
        return fit_transform_tfidf(dataset, self.value("idCol"), self.value("textCol"), size, sizes, self.value("hashing"))

    @staticmethod
    def _vector_parts(model: TfidfModel) -> dict[str, Any]:
        return {"counter": model.counter, "scale": model.scale.toArray()[None, :]}

    def _vectors(self, dataset: DataFrame) -> DataFrame:
        counter = self.parts["counter"]
        terms = list(counter.vocabulary) if isinstance(counter, CountVectorizerModel) else None
        sizes = TRIGRAMS if self.value("ngrams") else UNIGRAMS
        scale = DenseVector(self.parts["scale"][0])
        return TfidfModel(self.value("textCol"), sizes, counter, scale, terms).transform(
            dataset.select(self.value("idCol"), self.value("textCol"))
        )


class ReducedText(Vectorised):
    components = _whole("components", "columns to reduce to")


class ReducedTextModel(ReducedText, Model):
    """Parts: the fitted counter, its weights, and the singular vectors and values."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        svd = SvdModel(self.parts["vectors"], self.parts["values"][0])
        return dataset.join(svd.transform(self._vectors(dataset), self.value("idCol"), "tfidf"), self.value("idCol"))


class ReducedTextEstimator(ReducedText, Estimator):
    """TF-IDF reduced to ``svd_`` columns."""

    def _fit(self, dataset: DataFrame) -> ReducedTextModel:
        tfidf, rows = self._learn(dataset)
        svd = fit_svd(rows, "tfidf", tfidf.scale.size, self.value("components"))
        parts = {"vectors": np.ascontiguousarray(svd.components), "values": svd.singular_values[None, :]}
        return self._fitted(ReducedTextModel, self._vector_parts(tfidf) | parts)


class Topics(Vectorised):
    topics = _whole("topics", "number of topics")


class TopicsModel(Topics, Model):
    """Parts: the fitted counter, its weights and the topic model."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        shares = topic_features(self.parts["topics"], self._vectors(dataset), self.value("idCol"))
        return dataset.join(shares, self.value("idCol"))


class TopicsEstimator(Topics, Estimator):
    """Topic shares as ``topic_`` columns."""

    def _fit(self, dataset: DataFrame) -> TopicsModel:
        tfidf, rows = self._learn(dataset)
        return self._fitted(TopicsModel, self._vector_parts(tfidf) | {"topics": fit_topics(rows, "tfidf", self.value("topics"))})


class ItemCosine(TextColumns):
    """Similarity of a text with the text of its item; part ``items``: (key, item text)."""

    keyCol = _text("keyCol", "key of the item a text belongs to")
    itemTextCol = _text("itemTextCol", "text column of the items")
    outputCol = _text("outputCol", "similarity column")


class ItemCosineModel(ItemCosine, Model):
    """Parts: item keys, idf weights and unit item vectors, as tables. Rows without a known item are dropped."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        id_col, key, text = (self.value(n) for n in ("idCol", "keyCol", "textCol"))
        model = PairCosineModel(key, self.parts["keys"], self.parts["idf"], self.parts["vectors"])
        return dataset.join(model.transform(dataset.select(id_col, key, text), id_col, text, self.value("outputCol")), id_col)


class ItemCosineEstimator(ItemCosine, Estimator):
    """The idf comes from the frame it is fitted on, whatever frame is transformed later."""

    def _fit(self, dataset: DataFrame) -> ItemCosineModel:
        id_col, key, text = (self.value(n) for n in ("idCol", "keyCol", "textCol"))
        fitted = fit_pair_cosine(dataset.select(id_col, key, text), self.parts["items"], id_col, key, text, self.value("itemTextCol"))
        return self._fitted(ItemCosineModel, {"keys": fitted.keys, "idf": fitted.idf, "vectors": fitted.vectors})


def text_stage(
    id_col: str, text: str, lexicon: DataFrame | None = None, keywords: Sequence[str] = KEYWORDS,
    output: str = "compound_sentiment_score", **modifiers: Sequence[str],
) -> TextStatistics:
    parts = {} if lexicon is None else {"lexicon": lexicon}
    lists = {name: list(words) for name, words in modifiers.items()}
    return TextStatistics(parts, idCol=id_col, textCol=text, keywords=list(keywords), outputCol=output, **lists)


def entity_stage(id_col: str, text: str, gazetteer: DataFrame) -> EntityCounts:
    return EntityCounts({"gazetteer": gazetteer}, idCol=id_col, textCol=text)


def readability_stage(text: str) -> Readability:
    return Readability(textCol=text)


def date_stage(date: str, prefix: str = "review") -> DateParts:
    return DateParts(dateCol=date, prefix=prefix)


def tfidf_stage(
    id_col: str, text: str, max_features: int = 5000, components: int = 100, use_ngrams: bool = True, use_hashing: bool = False
) -> ReducedTextEstimator:
    return ReducedTextEstimator(
        idCol=id_col, textCol=text, maxFeatures=max_features, components=components, ngrams=use_ngrams, hashing=use_hashing
    )


def topic_stage(id_col: str, text: str, topics: int = 10, max_features: int = 5000) -> TopicsEstimator:
    return TopicsEstimator(idCol=id_col, textCol=text, topics=topics, maxFeatures=max_features, ngrams=False, hashing=False)


def cosine_stage(id_col: str, key: str, text: str, items: DataFrame, item_text: str, output: str) -> ItemCosineEstimator:
    return ItemCosineEstimator(
        {"items": items}, idCol=id_col, keyCol=key, textCol=text, itemTextCol=item_text, outputCol=output
    )
