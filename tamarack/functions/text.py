"""Text statistics, keyword flags, readability, tokens and n-grams as built-in expressions.

Null or empty text yields 0 in every feature.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.functions.constants import (
    KEYWORDS,
    PLAIN_WORD,
    SENTENCE_END,
    SILENT_E,
    TOKEN,
    VECTOR_WORD,
    VOWELS,
)


def _text(column: str | Column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column, F.lit(""))


def _letters(text: Column) -> Column:
    """Number of non-blank characters."""
    return F.length(F.translate(text, " \t\n\r\f\x0b", ""))


def whitespace_word_count(column: str | Column) -> Column:
    return F.regexp_count(_text(column), F.lit(r"\S+"))


def token_count(column: str | Column) -> Column:
    """Words and punctuation marks."""
    return F.regexp_count(_text(column), F.lit(TOKEN))


def sentence_count(column: str | Column) -> Column:
    text = _text(column)
    has_token = F.length(F.trim(text)) > 0
    return F.when(has_token, F.greatest(F.lit(1), F.regexp_count(text, F.lit(SENTENCE_END)))).otherwise(0)


def with_token_stats(df: DataFrame, column: str) -> DataFrame:
    text = _text(column)
    counted = df.withColumns(
        {
            "word_count": token_count(text),
            "num_sentences": sentence_count(text),
            "_letters": _letters(text),
        }
    )
    return counted.withColumn(
        "avg_word_length", F.coalesce(F.try_divide("_letters", "word_count"), F.lit(0.0))
    ).drop("_letters")


def keyword_flag(column: str | Column, keyword: str) -> Column:
    """Case-insensitive substring match."""
    return F.contains(F.lower(_text(column)), F.lit(keyword.lower())).cast("int")


def with_keyword_flags(df: DataFrame, column: str, keywords: Sequence[str] = KEYWORDS) -> DataFrame:
    lowered = df.withColumn("_lowered", F.lower(_text(column)))
    flags = {f"has_{k}": F.contains("_lowered", F.lit(k.lower())).cast("int") for k in keywords}
    return lowered.withColumns(flags).drop("_lowered")


def vector_words(column: str | Column) -> Column:
    """Lower-cased words of two or more letters, digits or underscores, in any script."""
    return F.regexp_extract_all(F.lower(_text(column)), F.lit(VECTOR_WORD), F.lit(0))


def _joined_from(words: Column, size: int) -> Callable[[Column], Column]:
    """Function of a 1-based place: the ``size`` words from there, joined by a space."""
    return lambda place: F.concat_ws(" ", *[F.get(words, place + (k - 1)) for k in range(size)])


def ngrams(words: str | Column, sizes: Sequence[int]) -> Column:
    """All n-grams of the given sizes, words joined by a space."""
    words = F.col(words) if isinstance(words, str) else words
    parts = []
    for size in sizes:
        if size == 1:
            parts.append(words)
            continue
        starts = F.when(
            F.size(words) >= size, F.sequence(F.lit(1), F.size(words) - (size - 1))
        ).otherwise(F.array().cast("array<int>"))
        parts.append(F.transform(starts, _joined_from(words, size)))
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def exploded_terms(df: DataFrame, keep: Sequence[str], terms: str | Column, output: str) -> DataFrame:
    """One row per array element.

    The outer form keeps the optimiser from adding a size filter, which would compute the array
    a second time.
    """
    return df.select(*keep, F.explode_outer(terms).alias(output)).where(F.col(output).isNotNull())


def syllables(word: Column) -> Column:
    """Vowel groups less a silent final e, at least one."""
    return F.greatest(
        F.lit(1),
        F.regexp_count(word, F.lit(VOWELS)) - F.regexp_count(word, F.lit(SILENT_E)),
    )


def with_readability(df: DataFrame, column: str) -> DataFrame:
    """Flesch reading ease, Flesch-Kincaid grade and SMOG index from their published formulas."""
    counted = df.withColumns(
        {
            "_syllables": F.transform(
                F.regexp_extract_all(F.lower(_text(column)), F.lit(PLAIN_WORD), F.lit(0)), syllables
            ),
            "_sentences": sentence_count(column),
        }
    )
    totals = counted.withColumns(
        {
            "_words": F.size("_syllables"),
            "_all": F.aggregate("_syllables", F.lit(0), lambda a, x: a + x),
            "_poly": F.size(F.filter("_syllables", lambda s: s >= 3)),
        }
    )
    per_sentence = F.col("_words") / F.col("_sentences")
    per_word = F.col("_all") / F.col("_words")
    usable = (F.col("_words") > 0) & (F.col("_sentences") > 0)
    return totals.withColumns(
        {
            "flesch_reading_ease": F.when(usable, 206.835 - 1.015 * per_sentence - 84.6 * per_word).otherwise(0.0),
            "flesch_kincaid_grade": F.when(usable, 0.39 * per_sentence + 11.8 * per_word - 15.59).otherwise(0.0),
            "smog_index": F.when(
                F.col("_sentences") >= 3,
                1.043 * F.sqrt(30.0 * F.col("_poly") / F.col("_sentences")) + 3.1291,
            ).otherwise(0.0),
        }
    ).drop("_syllables", "_sentences", "_words", "_all", "_poly")
