"""Toxicity by a weighted lexicon, matched by Aho-Corasick after folding, normalised by length, with exception phrases.

Terms are words, or word beginnings of four and six letters, after folding homoglyphs and digit substitutions. Their weights are
log odds between toxic and clean training texts; a term needs evidence (a likelihood ratio over ``evidence_bar``, which rises with the number of terms tested). Counts are kept
per fold, so that the curve from weighted matches to a probability is fitted on texts whose own fold did not shape the lexicon.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import partial

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamarack.llm.common import crc_fold, discard, tidied, written

#: Letters that look like Latin ones, and digits and signs that stand for letters.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p",
    "ѕ": "s", "т": "t", "у": "y", "х": "x", "ѵ": "v", "ԁ": "d", "ԛ": "q", "ԝ": "w", "α": "a", "ε": "e", "ι": "i", "κ": "k",
    "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g"}
SIGNS = {"@": "a", "$": "s"}

#: Phrases in which a term is harmless.
EXCEPTIONS = (
    "trash can", "trash bin", "white trash bag", "clown fish", "class clown", "sore loser", "pond scum", "soap scum",
    "not stupid", "not an idiot", "not worthless", "not pathetic",
)

#: Least likelihood-ratio statistic, and least log odds, of a term; chance terms to expect at most, for which the statistic rises.
EVIDENCE, LEAST_WEIGHT, CHANCE_TERMS = 12.0, 1.5, 1000

#: Labels up to which they are broadcast to the texts; beyond it the texts are shuffled to them.
BROADCAST_LABELS = 2_000_000

STEMS = (4, 6)
_FOLD = str.maketrans(HOMOGLYPHS | DIGITS | {chr(c): " " for c in range(128) if not chr(c).isalnum()})
_SIGN = re.compile(r"(?<=\w)[@$](?=\w)")
_BREAK = re.compile(r"[^\w]+|_+")


def folded_words(text: str | None) -> list[str]:
    """Words of a text in lower case, with look-alikes, digits and signs read as the letters they stand for."""
    if not text:
        return []
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    text = text.lower()
    if "@" in text or "$" in text:
        text = _SIGN.sub(lambda m: SIGNS[m[0]], text)
    text = text.translate(_FOLD)
    if not text.isascii():
        text = _BREAK.sub(" ", text)
    return text.split()


def terms_of(words: set[str]) -> set[str]:
    """Whole words (with a closing space) and word beginnings (without)."""
    out = {w + " " for w in words}
    for n in STEMS:
        out.update(w[:n] for w in words if len(w) >= n)
    return out


@tidied
def _count_batches(batches: Iterator[pa.RecordBatch], folds: Sequence[int]) -> Iterator[pa.RecordBatch]:
    """Per term: in how many toxic and clean texts of each fold; text, toxic, fold come in."""
    counts: Counter = Counter()

    def flush() -> Iterator[pa.RecordBatch]:
        terms: dict[str, list[int]] = {}
        for (term, slot), n in counts.items():
            terms.setdefault(term, [0] * (2 * len(folds)))[slot] += n
        counts.clear()
        if terms:
            columns = [pa.array(list(terms), pa.string())]
            columns += [pa.array([v[k] for v in terms.values()], pa.int64()) for k in range(2 * len(folds))]
            yield pa.RecordBatch.from_arrays(columns, ["term", *[f"n{k}" for k in range(2 * len(folds))]])

    for batch in batches:
        for text, toxic, fold in zip(*(batch.column(k).to_pylist() for k in range(3))):
            slot = 2 * folds.index(fold) + toxic
            counts.update((t, slot) for t in terms_of(set(folded_words(text))))
            if len(counts) > 150_000:
                yield from flush()
    yield from flush()


def evidence_bar(tested: int) -> float:
    """Least statistic of a term: exp(-bar / 2) bounds the chance of a term without effect, so at most ``CHANCE_TERMS`` pass by chance."""
    return max(EVIDENCE, 2 * math.log(max(tested, 1) / CHANCE_TERMS))


def _weight(toxic: Column, clean: Column, all_toxic: int, all_clean: int, bar: float) -> Column:
    """Log odds of a term; null without evidence that toxic texts use it more."""
    if not all_toxic or not all_clean:
        return F.lit(None).cast("double")
    share = (toxic + clean) / F.lit(float(all_toxic + all_clean))
    both = toxic * F.log(toxic / (share * all_toxic)) + F.when(clean > 0, clean * F.log(clean / (share * all_clean))).otherwise(0.0)
    weight = F.log((toxic + 0.5) / F.lit(all_toxic + 1.0)) - F.log((clean + 0.5) / F.lit(all_clean + 1.0))
    return F.when((toxic > 0) & (weight >= LEAST_WEIGHT) & (2 * both >= bar), weight)


class Matcher:
    """Aho-Corasick over folded words: sums the best term weight of every matched word outside exception phrases."""

    def __init__(self, lexicon: dict[str, float], exceptions: Sequence[str]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for term, weight in lexicon.items():
            self.automaton.add_word(" " + term, (len(term) + 1, weight))
        for phrase in exceptions:
            if words := folded_words(phrase):
                key = f" {' '.join(words)} "
                self.automaton.add_word(key, (len(key), None))
        if len(self.automaton):
            self.automaton.make_automaton()

    def raw(self, words: list[str]) -> float:
        if not len(self.automaton) or not words:
            return 0.0
        best: dict[int, float] = {}
        harmless: list[tuple[int, int]] = []
        for end, (size, weight) in self.automaton.iter(f" {' '.join(words)} "):
            start = end + 1 - size
            if weight is None:
                harmless.append((start, end))
            elif weight > best.get(start, 0.0):
                best[start] = weight
        for start, end in harmless:
            for at in [a for a in best if start <= a < end]:
                del best[at]
        return math.fsum(best.values())


@tidied
def _score_batches(
    batches: Iterator[pa.RecordBatch], lexicons: dict, exceptions: Sequence[str], keep: list[str], column: str, fold: str
) -> Iterator[pa.RecordBatch]:
    matchers = {k: Matcher(v, exceptions) for k, v in lexicons.items()}
    for batch in batches:
        value = []
        for text, part in zip(batch.column(batch.schema.get_field_index(column)), batch.column(batch.schema.get_field_index(fold))):
            words = folded_words(text.as_py())
            matcher = matchers.get(part.as_py(), matchers[None])
            value.append(math.log1p(matcher.raw(words) / math.sqrt(len(words))) if words else 0.0)
        columns = [batch.column(batch.schema.get_field_index(c)) for c in keep]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(value, pa.float64())], [*keep, "_strength"])


class ToxicityModel:
    """Lexicon, exception phrases and the curve from strength to probability."""

    def __init__(self, lexicon: dict[str, float], exceptions: Sequence[str], slope: float, intercept: float):
        self.lexicon, self.exceptions, self.slope, self.intercept = lexicon, tuple(exceptions), slope, intercept

    @staticmethod
    def strengths(docs: DataFrame, lexicons: dict, exceptions: Sequence[str], text: str, fold: str) -> DataFrame:
        keep = [c for c in docs.columns if c not in (fold, "_strength")]
        run = partial(_score_batches, lexicons=lexicons, exceptions=exceptions, keep=keep, column=text, fold=fold)
        return docs.mapInArrow(run, T.StructType([*(docs.schema[c] for c in keep), T.StructField("_strength", T.DoubleType())]))

    def score(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """Add ``score`` in 0..1 to every row. A null or empty text has strength 0. An existing ``score`` is replaced."""
        shown = docs.drop("score", "_fold", "_strength").withColumn("_fold", F.lit(None).cast("int"))
        out = self.strengths(shown, {None: self.lexicon}, self.exceptions, text, "_fold")
        z = F.lit(self.slope) * F.col("_strength") + F.lit(self.intercept)
        return out.withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(-z))).drop("_strength")


def train_toxicity(rows: DataFrame, exceptions: Sequence[str] = EXCEPTIONS, folds: Sequence[int] = (0, 1, 2)) -> ToxicityModel:
    """Fit on rows of text, toxic (0 or 1) and fold, of all of which counts are taken.

    Rows without text or label are left out. With labels of one class only, every score is that class's share, 0 or 1 at most
    nearly. The lexicon holds every term with evidence and goes to every executor.
    """
    rows = rows.where(F.col("text").isNotNull() & F.col("toxic").isin(0, 1)).select(
        "text", F.col("toxic").cast("int").alias("toxic"), F.col("fold").cast("int").alias("fold")
    )
    rows = written(rows, "toxicity-train")
    slots = [f"n{k}" for k in range(2 * len(folds))]
    sizes = {(r["fold"], r["toxic"]): r["n"] for r in rows.groupBy("fold", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = [sum(sizes.get((f, y), 0) for f in folds) for y in (0, 1)]
    if not total[0] or not total[1]:
        return ToxicityModel({}, exceptions, 0.0, -20.0 if total[0] or not total[1] else 20.0)
    schema = "term string, " + ", ".join(f"{s} bigint" for s in slots)
    counted = rows.mapInArrow(partial(_count_batches, folds=list(folds)), schema)
    counted = counted.groupBy("term").agg(*[F.sum(s).alias(s) for s in slots])
    counted = written(counted, "toxicity-terms")
    bar = evidence_bar(counted.count())

    def weight(without: int | None) -> Column:
        left = [k for k, f in enumerate(folds) if f != without]
        clean, toxic = (sum((F.col(f"n{2 * k + y}") for k in left), F.lit(0)) for y in (0, 1))
        size = [sum(sizes.get((folds[k], y), 0) for k in left) for y in (0, 1)]
        return _weight(toxic, clean, size[1], size[0], bar)

    parts = [None, *folds]
    weighed = counted.select("term", *[weight(f).alias(f"w{k}") for k, f in enumerate(parts)])
    found = weighed.where(F.coalesce(*[F.col(f"w{k}") for k in range(len(parts))]).isNotNull()).collect()
    lexicons = {f: {r["term"]: r[f"w{k}"] for r in found if r[f"w{k}"] is not None} for k, f in enumerate(parts)}
    discard(counted)
    seen = ToxicityModel.strengths(rows.select("text", "toxic", "fold", F.col("fold").alias("_fold")), lexicons, exceptions, "text", "_fold")
    points = seen.groupBy("toxic", F.round("_strength", 4).alias("x")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    points = points.select(F.col("toxic").cast("double").alias("label"), array_to_vector(F.array("x")).alias("features"), "n")
    curve = written(points, "toxicity-curve")
    fit = LogisticRegression(weightCol="n", regParam=1e-4, maxIter=50).fit(curve)
    discard(rows, curve)
    return ToxicityModel(lexicons[None], exceptions, max(0.0, float(fit.coefficients[0])), float(fit.intercept))


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text, toxic and fold of the training rows: those whose crc32(doc_id as text) mod 4 is not 2."""
    known = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = written(known.where(crc_fold("doc_id", 4) != 2), "labels")
    fold = crc_fold("doc_id", 4)
    joined = docs.select("doc_id", "text").join(F.broadcast(known) if known.count() <= BROADCAST_LABELS else known, "doc_id")
    return joined.select("text", "toxic", fold.alias("part")).where("part <> 2").select("text", "toxic", F.least("part", F.lit(2)).alias("fold"))
