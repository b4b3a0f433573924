import math
import random

import numpy as np
from pyspark.sql import functions as F

from tamarack.llm.containment import mark_leaks
from tamarack.llm.jaccard import bitmap, near_duplicates
from tamarack.llm.topk import search_cell, top_k
from tests.llm.conftest import ODD


def shingles(text, width=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def groups(rows):
    rows = [(i, t) for i, t in rows if i is not None]
    sets, parent = {i: shingles(t) for i, t in rows}, {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def family(rng, first, size, words=120, edits=3):
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for k in range(size):
        copy = list(base)
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        out.append((first + k, " ".join(copy)))
    return out


def test_components_equal_brute_force(spark, docs_of):
    rng = random.Random(5)
    rows = [r for k in range(12) for r in family(rng, 100 + 50 * k, rng.choice([1, 2, 5, 40]), rng.choice([6, 30, 120, 400]), rng.choice([1, 4, 9]))]
    chain = [f"c{k}" for k in range(80)]
    rows += [(5000 - k, " ".join(chain[k : k + 40])) for k in range(12)]  # each links to its neighbours only
    passage = " ".join(f"p{k}" for k in range(55))
    rows += [(6000 + k, f"{passage} " + " ".join(f"o{rng.randrange(10**6)}" for _ in range(rng.choice([5, 12, 60])))) for k in range(60)]
    rows += ODD
    rng.shuffle(rows)
    got = near_duplicates(docs_of(rows)).collect()
    want = groups(rows)
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["n_shingles"] == 4 and r["component_id"] is None
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]], r
    assert near_duplicates(docs_of([])).count() == 0


def test_bitmaps_bound_the_overlap():
    rng = np.random.default_rng(1)
    for _ in range(50):
        both, left, right = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in rng.integers(1, 90, 3))
        a, b = np.frombuffer(bitmap(np.concatenate([both, left])), np.uint8), np.frombuffer(bitmap(np.concatenate([both, right])), np.uint8)
        while len(a) != len(b):
            long, short = (a, b) if len(a) > len(b) else (b, a)
            a, b = long[: len(long) // 2] ^ long[len(long) // 2 :], short
        assert np.bitwise_count(a ^ b).sum() <= len(left) + len(right)


def test_leaks_equal_brute_force(spark, docs_of):
    rng = random.Random(6)
    items = [(k, " ".join(f"q{rng.randrange(400)}" for _ in range(rng.choice([1, 3, 5, 9, 40, 200])))) for k in range(60)]
    items += [(100, None), (101, ""), (102, " "), (None, "no id here at all ever"), (0, items[0][1])]
    rows = list(ODD)
    for k in range(300):
        words = [f"n{rng.randrange(10**6)}" for _ in range(rng.choice([0, 50, 3000]))]
        for _ in range(rng.choice([0, 1, 3])):
            item = (rng.choice(items)[1] or "").split()
            cut = rng.randrange(max(1, len(item) // 2))
            at = rng.randrange(len(words) + 1)
            words[at:at] = item[cut:]
        rows.append((200 + k, " ".join(words)))

    def held(text, item):
        w = item.encode().lower().split()
        if not w:
            return None
        d = (text or "").encode().lower().split()
        n = min(5, len(w))
        want = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
        shared = len(want & {tuple(d[i : i + n]) for i in range(len(d) - n + 1)})
        return (len(want), shared) if 100 * shared >= 75 * len(want) else None

    table = spark.createDataFrame(items, "item_id long, text string")
    want = sorted((str(i), k, *found) for i, t in rows for k, q in dict(x for x in items if x[0] is not None and x[1]).items() if (found := held(t, q)))
    for block in (2_000_000, 300):
        marked = mark_leaks(docs_of(rows).withColumn("leaks", F.lit(1)), table, block_shingles=block).collect()
        assert len(marked) == len(rows)
        assert sorted((str(r["doc_id"]), *leak) for r in marked for leak in r["leaks"]) == want
    assert mark_leaks(docs_of([]), table).count() == 0
    assert {len(r["leaks"]) for r in mark_leaks(docs_of(rows), table.limit(0)).collect()} == {0}


def brute(vectors, k):
    good = [(i, [math.floor(64 * x) for x in v]) for i, v in vectors if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in good:
        if q % 20 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q and len(a) == len(b))
            out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def test_top_k_equals_brute_force(spark):
    rng = random.Random(7)
    rows = [(k, [float(np.float32(rng.gauss(0, 0.2) + (k % 5 == j % 5) * 0.5)) for j in range(20)]) for k in range(900)]
    rows += [(900 + k, rows[20][1]) for k in range(30)]  # ties
    rows += [(1000, None), (1001, [None] * 20), (1020, [float("nan")] * 20), (1040, [float("inf")] + [0.0] * 19), (1060, []), (1080, [1.0, 2.0]), (1081, [1.0]), (None, [0.0] * 20)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in top_k(frame, F.col("vec_id") % 20 == 0).collect())
    assert got == brute(rows, 20)
    assert top_k(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_pruning_in_a_cell_keeps_the_result():
    rng = np.random.default_rng(2)
    centres = rng.integers(-60, 60, (8, 48))
    rows = centres[rng.integers(0, 8, 5000)] + rng.integers(-3, 4, (5000, 48))
    ids = rng.permutation(5000)
    query, row, score = search_cell(ids[:100], rows[:100], ids, rows, 10)
    full = rows[:100] @ rows.T
    for n in range(100):
        order = [j for j in np.lexsort((ids, -full[n])) if ids[j] != ids[n]][:10]
        mine = query == ids[n]
        assert row[mine].tolist() == ids[order].tolist() and score[mine].tolist() == full[n][order].tolist()
