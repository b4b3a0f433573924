"""Lexicon sentiment and gazetteer entity counts, driven by user-supplied tables."""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.functions import constants as C
from tamarack.operators.joins import lookup_join
from tamarack.session import cut_lineage

BLANK_SPLIT = r"[^ \t\n\r\f]+"
EDGE_MARKS = string.punctuation
NAME_WORD = r"[\p{L}\p{N}_']+"


def _stripped(word: Column) -> Column:
    """Drop punctuation at the edges unless that leaves two characters or fewer (emoticons)."""
    bare = F.btrim(word, F.lit(EDGE_MARKS))
    return F.when(F.length(bare) <= 2, word).otherwise(bare)


def _is_caps(word: Column) -> Column:
    return (F.upper(word) == word) & (F.lower(word) != word)


def _emphasis(text: Column) -> Column:
    exclamations = F.regexp_count(text, F.lit("!"))
    questions = F.regexp_count(text, F.lit(r"\?"))
    return F.least(exclamations, F.lit(4)) * C.VADER_EXCLAMATION + (
        F.when(questions <= 1, 0.0)
        .when(questions <= 3, questions * C.VADER_QUESTION)
        .otherwise(C.VADER_QUESTION_MAX)
    )


def with_sentiment(
    df: DataFrame,
    id_col: str,
    text: str,
    lexicon: DataFrame,
    boosters: Sequence[str] = (),
    dampeners: Sequence[str] = (),
    negations: Sequence[str] = (),
    output: str = "compound_sentiment_score",
) -> DataFrame:
    """Compound sentiment between -1 and 1 by the published VADER rules.

    ``lexicon`` has the columns term and valence. A lexicon hit is looked up with its three
    preceding words at hand, so boosters and negations need neither a window nor a second join;
    tokens of a text are summed before the shuffle.
    """
    words = df.select(
        id_col,
        F.transform(
            F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(BLANK_SPLIT), F.lit(0)), _stripped
        ).alias("_words"),
    ).withColumn("_lower", F.transform("_words", F.lower))
    facts = words.select(
        id_col,
        (F.exists("_words", _is_caps) & F.exists("_words", lambda w: ~_is_caps(w))).alias("_mixed"),
        F.array_position("_lower", "but").alias("_but"),
        F.transform(
            "_words",
            lambda w, i: F.struct(
                w.alias("word"),
                F.get("_lower", i).alias("term"),
                (i + 1).alias("place"),
                *[F.get("_lower", i - k).alias(f"before{k}") for k in (1, 2, 3)],
            ),
        ).alias("_places"),
    )
    placed = facts.select(id_col, "_mixed", "_but", F.explode_outer("_places").alias("_t")).select(
        id_col, "_mixed", "_but", "_t.*"
    )
    hits = lookup_join(placed, lexicon.select("term", "valence"), ["term"], [id_col, "place"])
    value = F.col("valence")
    value = value + F.when(
        F.col("_mixed") & _is_caps(F.col("word")), F.signum("valence") * C.VADER_CAPS
    ).otherwise(0.0)
    hits = hits.withColumn("_v", value)
    for k, fade in zip((1, 2, 3), C.VADER_DISTANCE):
        before = F.col(f"before{k}")
        boost = (
            F.when(before.isin(list(boosters)), C.VADER_BOOST)
            .when(before.isin(list(dampeners)), -C.VADER_BOOST)
            .otherwise(0.0)
        )
        turn = F.when(before.isin(list(negations)), C.VADER_NEGATION).otherwise(1.0)
        hits = hits.withColumn("_v", (F.col("_v") + F.signum("_v") * boost * fade) * turn)
    weight = (
        F.when(F.col("_but") == 0, 1.0)
        .when(F.col("place") < F.col("_but"), C.VADER_BEFORE_BUT)
        .when(F.col("place") > F.col("_but"), C.VADER_AFTER_BUT)
        .otherwise(1.0)
    )
    sums = hits.groupBy(id_col).agg(F.sum(F.col("_v") * weight).alias("_sum"))
    total = F.coalesce("_sum", F.lit(0.0))
    stressed = total + F.signum(total) * _emphasis(F.coalesce(text, F.lit("")))
    joined = df.join(sums, id_col, "left").withColumn("_s", stressed)
    compound = F.col("_s") / F.sqrt(F.col("_s") * F.col("_s") + C.VADER_ALPHA)
    return joined.withColumn(output, F.round(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), compound)), 4)).drop(
        "_sum", "_s"
    )


def name_table(gazetteer: DataFrame) -> DataFrame:
    """(surface, entity_type, head, length): the names as words with single blanks; names without any word are left out."""
    words = gazetteer.select(
        F.regexp_extract_all(F.coalesce("surface", F.lit("")), F.lit(NAME_WORD), F.lit(0)).alias("_words"), "entity_type"
    ).where(F.size("_words") > 0)
    return words.select(
        F.array_join("_words", " ").alias("surface"),
        "entity_type",
        F.get("_words", F.lit(0)).alias("head"),
        F.size("_words").alias("length"),
    )


def entity_mentions(df: DataFrame, id_col: str, text: str | Column, gazetteer: DataFrame) -> DataFrame:
    """(id, place, words, entity_type) of every gazetteer surface found in the text, of any number of words.

    ``gazetteer`` has the columns surface and entity_type. The longest surface wins at each
    place (of equal ones the first type), and a mention that begins inside an earlier one that was kept is dropped.
    A word is looked up among the first words of the names, which say what lengths to try there; only those places go on.
    An empty gazetteer and a null text give no rows.
    """
    names = cut_lineage(name_table(gazetteer))
    longest = names.agg(F.max("length")).first()[0] or 1
    heads = names.groupBy("head").agg(F.sort_array(F.collect_set("length")).alias("lengths"))
    words = df.select(
        F.col(id_col).alias("_id"),
        F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(NAME_WORD), F.lit(0)).alias("_words"),
    )
    follow = F.lit(longest - 1)
    placed = words.select(
        "_id",
        F.inline(
            F.transform(
                "_words",
                lambda w, i: F.struct((i + 1).alias("place"), w.alias("head"), F.slice("_words", i + 2, follow).alias("_next")),
            )
        ),
    )
    begun = lookup_join(placed, heads, ["head"], ["_id", "place"])
    tries = begun.withColumn("words", F.explode(F.filter("lengths", lambda n: n <= F.size("_next") + 1)))
    rest = F.slice("_next", F.lit(1), F.col("words") - 1)
    spelled = tries.select("_id", "place", "words", F.array_join(F.concat(F.array("head"), rest), " ").alias("surface"))
    hits = lookup_join(spelled, names.select("surface", "entity_type"), ["surface"], ["_id", "place"])
    hits = hits.withColumnRenamed("_id", id_col)
    hit = F.struct("place", (-F.col("words")).alias("short"), "entity_type")
    ordered = hits.groupBy(id_col).agg(F.array_sort(F.collect_list(hit)).alias("_hits"))  # the hits of one text
    start = F.struct(F.lit(0).alias("reach"), F.array().cast(ordered.schema["_hits"].dataType).alias("kept"))

    def step(acc: Column, h: Column) -> Column:
        kept = F.struct((h["place"] - h["short"]).alias("reach"), F.concat(acc["kept"], F.array(h)).alias("kept"))
        return F.when(h["place"] >= acc["reach"], kept).otherwise(acc)

    chosen = F.aggregate("_hits", start, step, lambda acc: acc["kept"])
    flat = ordered.select(id_col, F.explode(chosen).alias("_hit"))
    return flat.select(id_col, "_hit.place", (-F.col("_hit.short")).alias("words"), "_hit.entity_type")


def with_entity_counts(
    df: DataFrame,
    id_col: str,
    text: str,
    gazetteer: DataFrame,
    types: Sequence[str] = C.ENTITY_TYPES,
) -> DataFrame:
    """One ``entity_<TYPE>`` count per type; 0 where nothing is found."""
    mentions = entity_mentions(df, id_col, text, gazetteer)
    counts = mentions.groupBy(id_col).agg(
        *[F.count(F.when(F.col("entity_type") == t, 1)).alias(f"entity_{t}") for t in types]
    )
    return df.join(counts, id_col, "left").withColumns(
        {f"entity_{t}": F.coalesce(f"entity_{t}", F.lit(0)).cast("int") for t in types}
    )
