"""Quantiles and ranks against NumPy and brute force, with small bounds so that every path is taken."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tamarack.operators import selection
from tamarack.operators.selection import exact_quantiles, percentile_rank

WANTED = {"q0": 0.0, "q25": 0.25, "q50": 0.5, "q95": 0.95, "q100": 1.0}


def values_of(kind, n, rng):
    return {
        "normal": lambda: rng.normalvariate(0, 1), "wide": lambda: rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300),
        "hot": lambda: rng.choice([5.0, 5.0, rng.random()]), "near": lambda: 1.0 + rng.randrange(1000) * 2.0**-52,
        "clump": lambda: rng.choice([1e300, -1e300, 7 + rng.random() * 1e-9, 7.0]), "same": lambda: 3.0,
    }[kind], n


@pytest.mark.parametrize("few", [10, 100_000])
def test_quantiles(spark, monkeypatch, few):
    monkeypatch.setattr(selection, "FEW", few)
    rng = random.Random(3)
    groups = {g: [draw() for _ in range(n)] for g in ("normal", "wide", "hot", "near", "clump", "same") for draw, n in [values_of(g, 700, rng)]}
    groups |= {"few": [3.0, 1.0], "one": [2.0], None: [rng.random() for _ in range(300)], "null": []}
    rows = [(g, x) for g, all_ in groups.items() for x in all_] + [("null", None), ("few", None)]
    rng.shuffle(rows)
    got = {r["g"]: r for r in exact_quantiles(spark.createDataFrame(rows, "g string, x double"), ["g"], "x", WANTED).collect()}
    assert set(got) == {g for g, all_ in groups.items() if all_}
    for g, r in got.items():
        want = [np.quantile(groups[g], q) for q in WANTED.values()]
        assert np.allclose([r[name] for name in WANTED], want, rtol=1e-12, atol=0), g


@pytest.mark.parametrize("few", [5, 100_000])
def test_quantiles_of_other_types(spark, monkeypatch, few):
    monkeypatch.setattr(selection, "FEW", few)
    base = [2**62 + k for k in range(40)] + [-(2**62), 0, 1] * 3
    big = spark.createDataFrame([(x,) for x in base], "x long")
    row = exact_quantiles(big, [], "x", {"low": 0.0, "mid": 0.5}).first()
    assert row["low"] == -(2.0**62) and row["mid"] == float(sorted(base)[(len(base) - 1) // 2])
    cents = big.select((F.pmod("x", F.lit(97)) / 4).cast("decimal(9,2)").alias("x"))
    plain = sorted(float(r.x) for r in cents.collect())
    assert exact_quantiles(cents, [], "x", {"mid": 0.5}).first()["mid"] == pytest.approx(np.quantile(plain, 0.5))
    odd = spark.createDataFrame([(x,) for x in [math.inf, -math.inf, math.nan, 1.0] * 9], "x double")
    row = exact_quantiles(odd, [], "x", {"low": 0.0, "part": 0.3, "top": 1.0}).first()
    assert row["low"] == -math.inf and row["part"] == 1.0 and math.isnan(row["top"])
    none = exact_quantiles(odd.where("x = 2"), [], "x", {"mid": 0.5}).collect()
    assert [tuple(r) for r in none] == [(None,)]
    assert exact_quantiles(odd.where("x = 2").withColumn("g", F.lit(1)), ["g"], "x", {"mid": 0.5}).count() == 0


@pytest.mark.parametrize("few", [10, 100_000])
@pytest.mark.parametrize("keyed", [True, False])
def test_percentile_rank(spark, monkeypatch, few, keyed):
    monkeypatch.setattr(selection, "FEW", few)
    rng = random.Random(5)
    rows = [(k, rng.choice(["a", "b", None]), rng.choice([7.0, 7.0, rng.randrange(50) / 3, rng.random(), None])) for k in range(900)]
    rows += [(1000, "c", 1.0), (1001, "d", None)]
    keys = ["g"] if keyed else []
    frame = spark.createDataFrame(rows, "i long, g string, x double")
    got = {r["i"]: r["p"] for r in percentile_rank(frame, keys, "x", "p", ["i"]).collect()}
    assert len(got) == len(rows)
    for i, g, x in rows:
        peers = [y for _, h, y in rows if y is not None and (not keyed or h == g)]
        want = None if x is None else (sum(y < x for y in peers) + (sum(y == x for y in peers) + 1) / 2) / len(peers)
        assert got[i] == (want if want is None else pytest.approx(want))
    assert percentile_rank(frame.where("i < 0"), keys, "x", "p", ["i"]).columns == ["i", "g", "x", "p"]


def test_no_value_counts_are_written(spark, monkeypatch):
    """What is written grows with groups and bins, not with rows or distinct values."""
    sizes = []
    cut = selection.cut_lineage
    monkeypatch.setattr(selection, "FEW", 1000)
    monkeypatch.setattr(selection, "cut_lineage", lambda df: (out := cut(df), sizes.append(out.count()))[0])
    frame = spark.range(200_000).select((F.col("id") % 3).alias("g"), F.rand(3).alias("x"))
    exact_quantiles(frame, ["g"], "x", {"q25": 0.25, "q50": 0.5}).collect()
    assert max(sizes) <= 3 * 4
    sizes.clear()
    percentile_rank(frame, ["g"], "x", "p", ["x"]).count()
    assert max(sizes) < 20_000  # parts of octaves, and 16 or more parts of those with over 1000 rows
