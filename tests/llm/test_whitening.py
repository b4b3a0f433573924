import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tamarack.llm.whitening import exact_products, refined_eigenvectors, whiten

SCHEMA = "vec_id long, embedding array<double>, label int, component int, x string"


def frame(spark, vectors, repeat=4):
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v], 1, 2, "x") for i, v in vectors]
    return spark.createDataFrame(rows, SCHEMA).repartition(repeat)


def brute(vectors):
    """Integers, sums, covariance in Python integers, then a plain double solver."""
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(d)]
    away = [[n * r[j] - sums[j] for j in range(d)] for r in x]
    v = np.array([[sum(a[i] * a[j] for a in away) / n**3 for j in range(d)] for i in range(d)])
    return n, [sum(a * a for a in r) for r in away], np.array([[a / n for a in r] for r in away]), v


@pytest.mark.parametrize("shift,size,spread", [(0, 60, 1), (20_000, 60, 1), (3, 40, 50_000)])
def test_equals_brute_force(spark, shift, size, spread):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(size, 5)) * spread * np.arange(1, 6) + shift
    got = whiten(frame(spark, list(enumerate(vectors.tolist()))), components=4).collect()
    n, deviation, centred, v = brute(vectors.tolist())
    e, axes = np.linalg.eigh(v)
    e, axes = e[::-1], axes[:, ::-1]
    assert len(got) == size * 4
    signs = {}
    for r in got:
        k = r.component - 1
        want = centred[r.vec_id] @ axes[:, k] / math.sqrt(e[k])
        sign = signs.setdefault(k, math.copysign(1, want * r.whitened))
        assert r.n == n and int(r.deviation) == deviation[r.vec_id]
        assert r.whitened * sign == pytest.approx(want, rel=1e-9, abs=1e-9)
        assert r.explained == pytest.approx(e[k] / v.trace(), rel=1e-9)
        assert r.identity_error < 1e-9


def test_clusters_of_eigenvalues():
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.normal(size=(40, 40)))[0].astype(np.longdouble)
    for _ in range(3):
        q = q + q @ (np.eye(40) - q.T @ q) / 2
    for values in (
        np.linspace(1, 2, 40), np.ones(40), np.r_[np.zeros(20), np.ones(20)], np.r_[np.full(20, 3.0), np.full(10, 3 + 1e-9), np.linspace(1, 2, 10)],
        np.r_[1 + 1e-12 * np.arange(20), np.logspace(-8, 3, 20)],
    ):
        a = (q * values.astype(np.longdouble)) @ q.T
        a = (a + a.T) / 2
        e, x = refined_eigenvectors(a)
        assert np.abs(a @ x - x * e).max() < 1e-17 * values.max()
        assert np.abs(x.T @ x - np.eye(40)).max() < 1e-17
        assert np.abs(e - np.sort(values)[::-1]).max() < 1e-17 * values.max()
    # vectors of eigenvalues 1e-9 apart are told apart, which doubles alone cannot do to this many digits
    a = (q * np.r_[1 + 1e-9 * np.arange(40)].astype(np.longdouble)) @ q.T
    _, x = refined_eigenvectors((a + a.T) / 2)
    assert np.abs(np.abs(x.T @ q[:, ::-1]) - np.eye(40)).max() < 1e-8


def test_products_of_large_integers_are_exact():
    rng = np.random.default_rng(2)
    for most in (2**40, 2**20, 5):
        rows = rng.integers(-most, most, (1500, 4))
        assert (exact_products(rows) == rows.astype(object).T @ rows.astype(object)).all()


def test_odd_rows(spark):
    rng = random.Random(4)
    good = [(i, [rng.random(), rng.random(), 0.5]) for i in range(20)] + [(None, [0.1, 0.2, 0.5]), (3, [0.9, 0.1, 0.5]), (3, [0.9, 0.1, 0.5])]
    odd = [(100, None), (101, []), (102, [1, None, 1]), (103, [1, math.nan, 1]), (104, [1, math.inf, 1]), (105, [1, 1e300, 1]), (106, [1, 2])]
    got = whiten(frame(spark, good + odd), components=32)
    assert got.groupBy("component").count().where(f"count = {len(good)}").count() == 3
    assert got.where("component = 3 AND whitened IS NULL AND explained = 0").count() == len(good)  # a constant dimension
    assert got.where("component < 3 AND whitened IS NULL").count() == 0 and got.where("vec_id IS NULL").count() == 3
    assert got.agg(F.max("identity_error")).first()[0] < 1e-9
    assert whiten(frame(spark, odd[:6])).count() == 0
    one = whiten(frame(spark, [(1, [1, 2])])).collect()
    assert [(r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, None, 0.0, 0.0)] * 2
