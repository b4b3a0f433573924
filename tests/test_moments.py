"""Correlations by co-moments, density by binned weights, topics by mini-batches, names of any length."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tamarack.operators import factors, lexicon, profile, vectors
from tamarack.operators.correlation import correlation_matrix, pearson


def test_moments_equal_sparks_aggregates(spark):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(3000):
        a = float(rng.normal())
        rows.append((a, None if i % 3 else a * 2 + float(rng.normal()), 1e9 + a, 0.1, i % 7 if i % 2 else None, float("nan") if i == 50 else a, None))
    columns = ["a", "b", "far", "same", "whole", "odd", "none"]
    df = spark.createDataFrame(rows, "a double, b double, far double, same double, whole int, odd double, none double").repartition(7)
    got = {(r["a"], r["b"]): r["correlation"] for r in correlation_matrix(df, columns).collect()}
    want = df.agg(*[pearson(x, y).alias(f"{x}|{y}") for x in columns for y in columns]).first().asDict()
    assert len(got) == 49
    for x in columns:
        for y in columns:
            mine, theirs = got[x, y], want[f"{x}|{y}"]
            if "same" in (x, y):  # merged means of 0.1 are not always 0.1 in the aggregates
                assert np.isnan(mine) if "odd" in (x, y) else mine is None
                continue
            assert (mine is None) == (theirs is None), (x, y, mine, theirs)
            assert mine is None or (np.isnan(mine) and np.isnan(theirs)) or abs(mine - theirs) < 1e-7, (x, y)


def test_moments_of_nothing_and_of_many_columns(spark):
    empty = spark.createDataFrame([], "a double, b int")
    assert [r["correlation"] for r in correlation_matrix(empty, ["a", "b"]).collect()] == [None] * 4
    wide = spark.range(500).select(*[F.rand(i).alias(f"x{i}") for i in range(180)])
    numbers = np.array(wide.collect())
    got = correlation_matrix(wide, wide.columns).collect()
    assert len(got) == 180 * 180
    assert abs(np.array([r["correlation"] for r in got]).reshape(180, 180) - np.corrcoef(numbers.T)).max() < 1e-9


def test_binned_density_stays_within_its_bound(spark):
    values = np.concatenate([np.random.default_rng(3).lognormal(size=2000), [5.0] * 500])
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    exact = {r["point"]: r["density"] for r in profile.density(df, "v").collect()}
    for cells in (64, 4096):
        got = {r["point"]: r["density"] for r in profile.binned_density(df, "v", cells=cells).collect()}
        width = values.std(ddof=1) * len(values) ** -0.2
        bound = ((values.max() - values.min()) / cells) ** 2 / (8 * np.sqrt(2 * np.pi) * width**3)
        assert got.keys() == exact.keys() and max(abs(got[p] - exact[p]) for p in exact) <= bound * (1 + 1e-9)
    for odd in ([], [(None,)], [(2.0,)], [(2.0,), (2.0,)]):
        assert profile.binned_density(spark.createDataFrame(odd, "v double"), "v").count() == 0


def test_topics_move_with_every_batch(spark):
    rng = random.Random(2)
    texts = [(i, " ".join(rng.choice(["sea ship wave", "tree leaf root"][i % 2].split()) for _ in range(30))) for i in range(200)]
    df = spark.createDataFrame(texts, "id int, t string")
    _, rows = vectors.fit_transform_tfidf(df, "id", "t", 50, vectors.UNIGRAMS)
    whole, batched = (factors.fit_topics(rows, "tfidf", 2, batches=b) for b in (1, 4))
    assert (whole.getMaxIter(), batched.getMaxIter()) == (10, 40) and batched.getSubsamplingRate() == 0.25
    assert batched.logPerplexity(rows) <= whole.logPerplexity(rows) + 0.05
    again = factors.fit_topics(rows, "tfidf", 2)
    assert np.allclose(again.topicsMatrix().toArray(), batched.topicsMatrix().toArray(), rtol=1e-6)


def found_by_hand(text, names):
    words = re.findall(r"[\w']+", text or "")
    table = {}
    for surface, kind in names:
        key = tuple(re.findall(r"[\w']+", surface or ""))
        if key:
            table[key] = min(kind, table.get(key, kind))
    out, at = [], 0
    while at < len(words):
        fits = [n for n in range(1, 9) if tuple(words[at:at + n]) in table and at + n <= len(words)]
        if fits:
            out.append((at + 1, max(fits), table[tuple(words[at:at + max(fits)])]))
        at += max(fits, default=1)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_names_of_one_to_eight_words(spark, seed):
    rng = random.Random(seed)
    names = [(" ".join(rng.choices("abcd", k=n)), rng.choice("XYZ")) for n in range(1, 9) for _ in range(4)]
    names += [("New York City Marathon", "EVENT"), ("St. Louis", "GPE"), ("St Louis", "FAC"), ("", "X"), (None, "X"), ("...", "Y")]
    texts = [" ".join(rng.choices("abcde", k=rng.randrange(60))) for _ in range(40)]
    texts += ["The New York City Marathon, in St. Louis", "New York City", None, "", "a " * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "head int, t string")  # the id column has the name of an inner one
    table = spark.createDataFrame(names, "surface string, entity_type string")
    got = {}
    for r in lexicon.entity_mentions(df, "head", "t", table).collect():
        got.setdefault(r[0], []).append(tuple(r)[1:])
    for i, text in enumerate(texts):
        assert sorted(got.get(i, [])) == found_by_hand(text, names), text
    assert lexicon.entity_mentions(df, "head", "t", table.limit(0)).count() == 0
