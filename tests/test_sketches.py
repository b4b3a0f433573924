"""Mergeable profiles: merged parts against the whole, and both against exact values."""

import math
import random

import numpy as np

from tamarack.operators.sketches import DISTINCT_ERROR, RANK_ERROR, merge_sketches, read_sketches, sketch_columns
from tamarack.session import cut_lineage

WANTED = {"q05": 0.05, "q50": 0.5, "q95": 0.95}


def test_merged_parts_are_the_whole(spark):
    rng = random.Random(8)
    rows = [(f"day{n % 9}" if n % 3 else "hot", rng.normalvariate(0, 5), n % 1000 if n % 4 else None) for n in range(60_000)]
    frame = spark.createDataFrame(rows, "part string, x double, n long")
    parts = cut_lineage(sketch_columns(frame, ["x", "n"], ["part"]))
    assert parts.count() == 2 * len({r[0] for r in rows})
    merged = {r["feature"]: r for r in read_sketches(merge_sketches(parts), WANTED).collect()}
    whole = {r["feature"]: r for r in read_sketches(sketch_columns(frame, ["x", "n"]), WANTED).collect()}
    for k, name in ((1, "x"), (2, "n")):
        values = np.sort([float(r[k]) for r in rows if r[k] is not None])
        for got in (merged[name], whole[name]):
            assert (got["rows"], got["missing"], got["low"], got["high"]) == (len(rows), len(rows) - len(values), values[0], values[-1])
            assert math.isclose(got["mean"], values.mean(), rel_tol=1e-9, abs_tol=1e-12)
            assert abs(got["distinct"] / len(set(values)) - 1) <= 2 * DISTINCT_ERROR
            for q, p in WANTED.items():
                low, high = np.searchsorted(values, got[q], "left"), np.searchsorted(values, got[q], "right")
                assert low - 2 * RANK_ERROR * len(values) <= p * len(values) <= high + 2 * RANK_ERROR * len(values)
    twice = {r["feature"]: r for r in read_sketches(merge_sketches(merge_sketches(parts, ["part"])), WANTED).collect()}
    assert all(twice[f]["rows"] == merged[f]["rows"] and twice[f]["distinct"] == merged[f]["distinct"] for f in merged)


def test_missing_values_and_empty_tables(spark):
    rows = [("a", None), ("a", math.nan), ("b", 1.0), ("b", -0.0), ("b", 0.0), ("b", 1.0), (None, 7.0)]
    frame = spark.createDataFrame(rows, "part string, x double")
    got = {r["part"]: r for r in read_sketches(sketch_columns(frame, ["x"], ["part"]), WANTED).collect()}
    assert (got["a"]["rows"], got["a"]["missing"], got["a"]["distinct"], got["a"]["q50"], got["a"]["mean"]) == (2, 2, 0, None, None)
    assert (got["b"]["distinct"], got["b"]["low"], got["b"]["high"], got["b"]["q95"]) == (2, 0.0, 1.0, 1.0)
    assert got[None]["q50"] == 7.0
    whole = read_sketches(merge_sketches(sketch_columns(frame, ["x"], ["part"])), WANTED).first()
    assert (whole["rows"], whole["missing"], whole["distinct"]) == (7, 2, 3)
    empty = read_sketches(sketch_columns(frame.limit(0), ["x"]), WANTED).first()
    assert (empty["rows"], empty["missing"], empty["distinct"], empty["q50"]) == (0, 0, 0, None)
    assert read_sketches(merge_sketches(sketch_columns(frame.limit(0), ["x"], ["part"])), WANTED).count() == 0
