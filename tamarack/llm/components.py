"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.llm.common import discard, written

#: Edges (16 bytes each) that one task handles.
FEW = 50_000


def _least(edges: DataFrame) -> DataFrame:
    """The smallest neighbour of every ``u``, or ``u`` itself."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for all nodes of the undirected ``edges``; a component is named by its smallest node.

    Each step is two joins with one row per node; a node with many neighbours is split by the skew handling of joins. The steps
    are written, and end when the edges are stars around the smallest nodes. Up to ``FEW`` edges are kept in one partition, which
    spares the shuffles; the steps and the result are the same.
    """
    edges = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    source = edges = written(edges, "edges")
    before = _state(edges)
    while before[0]:
        if before[0] <= FEW:
            edges = edges.coalesce(1)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        both = both.coalesce(1) if before[0] <= FEW else both
        large = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.join(_least(large), "u")
        small = down.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(down.select("u", F.col("m").alias("v")))
        small = small.coalesce(1) if before[0] <= FEW else small
        last, edges = source, written(small.where("u <> v").distinct(), "edges")
        source = edges
        discard(last)
        state = _state(edges)
        if state == before:
            break
        before = state
    tops = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(tops)
