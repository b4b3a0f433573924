import math

import numpy as np
import pytest

from tamarack.llm import codes
from tamarack.llm.codes import blur, decode, encode, near_embeddings, plan_bands, unit

SCHEMA = "vec_id long, embedding array<double>, label int, class long, band int, n int"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 0, 1, 2, 3) for i, v in rows], SCHEMA)


def brute(rows, threshold=0.9):
    """Number of links and smallest linked id per id; ids are unique."""
    ids = [i for i, _ in rows]
    x = np.array([v for _, v in rows], float)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    linked = x @ x.T >= threshold
    np.fill_diagonal(linked, False)
    parent = list(range(len(ids)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in zip(*np.nonzero(linked)):
        parent[find(a)] = find(b)
    least = {}
    for k, i in enumerate(ids):
        least[find(k)] = min(i, least.get(find(k), i))
    return {i: (int(linked[k].sum()), least[find(k)]) for k, i in enumerate(ids)}


def family(rng, n, dims, noise):
    centre = rng.normal(size=dims)
    centre /= np.linalg.norm(centre)
    return centre + noise * rng.normal(size=(n, dims)) / math.sqrt(dims)


@pytest.mark.parametrize("block,bucket", [(2048, 256), (20, 8)])
def test_equals_brute_force(spark, monkeypatch, block, bucket):
    """Copies, chains, tight families and noise; the second run cuts nearly all buckets into blocks."""
    monkeypatch.setattr(codes, "BLOCK", block)
    monkeypatch.setattr(codes, "BUCKET", bucket)
    monkeypatch.setattr(codes, "PACK", 500)
    rng = np.random.default_rng(8)
    x = [rng.normal(size=(300, 32)), family(rng, 150, 32, 0.1), family(rng, 30, 32, 0.2), family(rng, 5, 32, 0.01)]
    angle = np.arange(12) * 0.2  # neighbours link, others do not
    chain = np.zeros((12, 32))
    chain[:, 0], chain[:, 1] = np.cos(angle), np.sin(angle)
    x += [chain, np.repeat(rng.normal(size=(1, 32)), 40, axis=0), 3e200 * chain[:1], -chain[:2]]
    x = np.concatenate(x)
    ids = rng.permutation(len(x)) + 7
    rows = list(zip(ids.tolist(), x.tolist()))
    got = {r.vec_id: r for r in near_embeddings(frame(spark, rows).repartition(5)).collect()}
    scaled = (x / np.abs(x).max(axis=1, keepdims=True)).tolist()
    want = brute(list(zip(ids.tolist(), scaled)))
    assert len(got) == len(rows)
    wrong = [i for i, (n, least) in want.items() if (got[i].n_links, got[i].component_id) != (n, least)]
    assert not wrong
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_recall_at_the_threshold(spark):
    """Pairs of cosine just above 0.9 and just below: 99 of 100 found, none that should not be."""
    rng = np.random.default_rng(9)
    a = unit(rng.normal(size=(2000, 64)))
    g = rng.normal(size=(2000, 64))
    g = unit(g - (g * a).sum(axis=1, keepdims=True) * a)
    cosine = np.where(np.arange(2000) % 2 == 0, 0.9005, 0.8995)[:, None]
    b = cosine * a + np.sqrt(1 - cosine**2) * g
    rows = list(zip(range(4000), np.concatenate([a, b]).tolist()))
    got = {r.vec_id: r for r in near_embeddings(frame(spark, rows)).collect()}
    found = sum(got[2000 + k].component_id == k for k in range(0, 2000, 2))
    assert found >= 970
    assert all(got[2000 + k].n_links == 0 for k in range(1, 2000, 2))


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(10)
    x, y = unit(rng.normal(size=(400, 48))), unit(rng.normal(size=(400, 48)))
    y = unit(x + 0.5 * y)
    (c1, f1), _ = encode(x, 256)
    _, (d2, g2) = encode(y, 256)
    guess, true = (decode(c1, f1, 48, 0) * decode(d2, g2, 48, 1)).sum(axis=1), (x * y).sum(axis=1)
    w1, w2 = blur(f1, 256), blur(g2, 256)
    spread = np.sqrt(w1**2 + w2**2 + 48 * (w1 * w2) ** 2)
    off = (guess - true) / spread
    # a vector's error is at right angles to it, so the estimates of close pairs spread less than the bound allows
    assert abs(off.mean()) < 0.1 and 0.3 < off.std() < 1 and np.abs(off).max() < codes.SPREADS


def test_bands_follow_from_the_recall():
    for n in (1, 300, 10**5, 10**9):
        bits, bands = plan_bands(n, 0.9, 0.99)
        assert 1 - (1 - (1 - math.acos(0.9) / math.pi) ** bits) ** bands >= 0.99


def test_odd_rows(spark):
    rows = [
        (1, None), (2, []), (3, [0, 0]), (4, [1, None]), (5, [1, math.nan]), (6, [math.inf, 1]), (7, [1, 0]), (8, [2, 0]), (8, [2, 0]),
        (9, [1, 0, 0]), (None, [1, 0]), (10, [0, 1]), (3, [0, 0]), (11, [1e-300, 0]),
    ]
    got = sorted(((r.vec_id or -1, r.n_links, r.component_id, r.kept) for r in near_embeddings(frame(spark, rows)).collect()), key=str)
    want = [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True), (7, 3, 7, True)]
    want += [(8, 3, 7, False), (8, 3, 7, False), (9, 0, 9, True), (-1, 0, None, True), (10, 0, 10, True), (11, 3, 7, False)]
    assert got == sorted(want, key=str)
    assert near_embeddings(frame(spark, [])).count() == 0
