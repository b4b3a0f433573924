"""Frequent terms by hashed counters against plain counts."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tamarack.operators import frequent
from tamarack.operators.frequent import candidate_counts, frequent_phrases, frequent_terms, hashed_counters
from tamarack.operators.vectors import TRIGRAMS, vocabulary


def best(words, size):
    return sorted(Counter(words).items(), key=lambda x: (-x[1], x[0].encode()))[:size]


@pytest.mark.parametrize("width", [2, 8, frequent.BITS])
def test_equal_to_plain_counts(spark, monkeypatch, width):
    """With few counters all are shared and the floor falls until the list is proven."""
    monkeypatch.setattr(frequent, "BITS", width)
    monkeypatch.setattr(frequent, "WIDTH", 1 << width)
    rng = random.Random(5)
    words = [f"w{int(rng.paretovariate(0.6))}" for _ in range(4000)] + ["é", "z", ""] * 7 + [f"t{n}" for n in range(50)] * 3
    table = spark.createDataFrame([(w,) for w in [*words, None, None]], "term string")
    for size in (0, 1, 20, 45, 10_000):
        assert [tuple(r) for r in frequent_terms(table, size).collect()] == best(words, size)
    assert frequent_terms(table.limit(0), 5).collect() == []


def test_rare_terms_are_not_counted(spark):
    """One word in a third of all rows, 60 common ones, 200,000 that stand once: the second pass sees hardly any of the last."""
    rows = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 100 < 34, F.concat(F.lit("c"), F.col("id") % 61)).otherwise(F.concat(F.lit("r"), "id")).alias("term")
    )
    counters = hashed_counters(rows)
    assert counters.count() <= frequent.HASHES * frequent.WIDTH
    top = frequent_terms(rows, 50).collect()
    plain = rows.groupBy("term").agg(F.count(F.lit(1)).alias("tf")).orderBy(F.desc("tf"), "term").limit(50).collect()
    assert top == plain and top[0]["term"] == "hot"
    assert candidate_counts(rows, counters, top[-1]["tf"]).count() < 100


def test_vocabulary_takes_both_ways(spark, data):
    texts = spark.read.parquet(f"{data}/documents.parquet")
    for sizes in ((1,), TRIGRAMS):
        assert vocabulary(texts, "text", 300, sizes, direct_bytes=-1).collect() == vocabulary(texts, "text", 300, sizes).collect()


@pytest.mark.parametrize("hashed", [False, True])
@pytest.mark.parametrize("size", [7, 100_000])
def test_phrases_equal_plain_counts(spark, size, hashed):
    """Ties at the last place, texts without words, fewer phrases than wanted, and one more word than the queries take."""
    rng = random.Random(size)
    texts = [[f"w{min(30, int(rng.paretovariate(0.8)))}" for _ in range(rng.randrange(12))] for _ in range(60)] + [["é", "z", "é", "z"]] * 4
    plain = [" ".join(t[i : i + n]) for t in texts for n in range(1, 5) for i in range(len(t) - n + 1)]
    rows = spark.createDataFrame([(t,) for t in [*texts, None, []]], "words array<string>")
    assert [tuple(r) for r in frequent_phrases(rows, size, 4, hashed=hashed).collect()] == best(plain, size)
    assert frequent_phrases(rows.limit(0), size, 3, hashed=hashed).collect() == []


def test_rare_words_form_no_phrases(spark, monkeypatch):
    """Every text is a common pair and a word of its own: phrases with that word are never counted."""
    seen = []
    cut = frequent.cut_lineage
    monkeypatch.setattr(frequent, "cut_lineage", lambda df: seen.append(cut(df)) or seen[-1])
    rows = spark.range(2000).select(F.array(F.lit("a"), F.lit("b"), F.concat(F.lit("r"), "id"), F.lit("a")).alias("words"))
    assert [tuple(r) for r in frequent_phrases(rows, 2, 3).collect()] == [("a", 4000), ("a b", 2000)]
    counts = [df.count() for df in seen if set(df.columns) >= {"tf", "i1"}]
    assert counts and max(counts) == 1
