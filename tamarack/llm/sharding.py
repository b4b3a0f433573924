"""Sharding by a K-d tree over document metadata, cut at distributed weighted medians.

Rows with equal texts form one point, whose weight is their bytes and whose coordinates are metadata; a point heavier than a
small share of a shard is dealt into pieces first, so a text that a third of all rows repeat does not unbalance the shards.
Nodes are split along their widest dimension (as a share of that dimension's extent in the whole table) at the value that
divides the bytes in the ratio of the leaves to either side, until each node is one leaf of the target bytes. Medians are found
by refining histograms of the node's points: the driver sees a fixed number of bins per node, never the points.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tamarack.llm.common import written

#: Bins of one refinement step, the share of a leaf within which a cut may miss, and how many pieces of a leaf one text may fill.
BINS, TOLERANCE, PIECES = 512, 1 / 128, 64

#: Rows of a shard that are numbered in one group on average, fewest groups of a shard, and equal rows that one task writes out at once.
CHUNK, LEAST_CHUNKS, COPIES = 100_000, 16, 65_536


def _points(rows: DataFrame, dimensions: Sequence[str], target: float) -> tuple[DataFrame, DataFrame]:
    """``rows`` with a point number, and the points: group, piece, weight, x0.., and tie in 0..1."""
    sizes = rows.groupBy("group").agg(F.sum("size").alias("bytes"))
    heavy = sizes.where(F.col("bytes") > target / PIECES)  # fewer than leaves x PIECES groups, whatever the table's size
    heavy = heavy.select("group", F.ceil(F.col("bytes") * PIECES / F.lit(target)).cast("int").alias("pieces"))
    dealt = rows.join(F.broadcast(heavy), "group", "left")
    dealt = dealt.withColumn("piece", F.pmod(F.xxhash64("doc_id", "group"), F.coalesce("pieces", F.lit(1))).cast("int")).drop("pieces")
    dealt = written(dealt, "shard-rows")
    tie = F.shiftrightunsigned(F.xxhash64("group", "piece"), 11).cast("double") / F.lit(2.0**53)
    points = dealt.groupBy("group", "piece").agg(
        F.sum("size").cast("double").alias("weight"), *[F.min(d).alias(f"x{k}") for k, d in enumerate(dimensions)]
    )
    return dealt, points.withColumn("tie", tie)


def _bounds(points: DataFrame, dims: int) -> dict[int, dict]:
    values = [f(f"x{k}").alias(f"{n}{k}") for k in range(dims) for n, f in (("low", F.min), ("high", F.max))]
    return {r["node"]: r.asDict() for r in points.groupBy("node").agg(F.sum("weight").alias("weight"), *values).collect()}


def _choose(cuts: DataFrame, dims: int) -> Column:
    value = F.lit(None).cast("double")
    for k in range(dims):
        value = F.when(F.col("dim") == k, F.col(f"x{k}")).otherwise(value)
    return value


def _refine(points: DataFrame, state: dict[int, dict], dims: int, slack: float) -> None:
    """Narrow every node's cut until the bytes below it are within ``slack`` of the wanted, or one point holds the rest.

    A cut is (value, tie): points below the value, or at it with a smaller tie, go left.
    """
    spark = points.sparkSession
    open_nodes = set(state)
    while open_nodes:
        rows = [(n, s["dim"], s["on_tie"], s["at"], s["low"], s["high"]) for n, s in state.items() if n in open_nodes]
        asked = spark.createDataFrame(rows, "node int, dim int, on_tie boolean, at double, low double, high double")
        joined = points.join(F.broadcast(asked), "node").withColumn("x", _choose(points, dims))
        inside = joined.where(~F.col("on_tie") | (F.col("x") == F.col("at")))
        inside = inside.withColumn("y", F.when(F.col("on_tie"), F.col("tie")).otherwise(F.col("x")))
        inside = inside.where((F.col("y") >= F.col("low")) & (F.col("y") <= F.col("high")))
        width = F.col("high") - F.col("low")
        bin_ = F.least(F.floor((F.col("y") - F.col("low")) / width * BINS), F.lit(BINS - 1))
        binned = inside.groupBy("node", F.when(width > 0, bin_).otherwise(0).alias("bin"))
        got: dict[int, list] = {}
        for r in binned.agg(F.sum("weight").alias("w"), F.min("y").alias("lo"), F.max("y").alias("hi")).collect():
            got.setdefault(r["node"], []).append((r["bin"], r["w"], r["lo"], r["hi"]))
        for node in list(open_nodes):
            s, passed = state[node], state[node]["below"]
            for _, weight, lo, hi in sorted(got.get(node, [])):
                if passed + weight < s["wanted"] - slack:
                    passed += weight
                    continue
                s["below"] = passed
                over, short = passed + weight - s["wanted"], s["wanted"] - passed
                if min(over, short) <= slack or (lo == hi and s["on_tie"]):
                    s["cut"] = (s["at"] if s["on_tie"] else (hi if over <= short else lo), (hi if over <= short else lo) if s["on_tie"] else None)
                    s["inclusive"] = over <= short
                    open_nodes.discard(node)
                elif lo == hi:
                    s |= {"on_tie": True, "at": lo, "low": 0.0, "high": 1.0}
                else:
                    s |= {"low": lo, "high": hi}
                break
            else:
                s |= {"cut": (s["high"], None), "inclusive": True}
                open_nodes.discard(node)


def kd_shards(
    docs: DataFrame,
    target_bytes: float | None = None,
    shards: int | None = None,
    dimensions: Sequence[str] = ("length", "source", "lang", "doc_id"),
    text: str = "text",
) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot for every row of ``docs`` (doc_id, text and the metadata columns).

    Give ``target_bytes``, or the number of ``shards``. Rows of equal texts stay together unless they exceed 1/64 of a shard. A
    null text has no bytes and shares a group with the empty text; null metadata sorts first; rows that repeat wholly are kept
    and numbered in turn. Numeric metadata are used as they are, other columns by their CRC-32; a column that is absent, or
    null throughout, is constant and never split. An empty table gives an empty result. Other columns are left out.
    """
    plain = F.coalesce(F.col(text), F.lit(""))
    size = (F.octet_length(plain) + 8).cast("long")
    coordinates = {}
    for d in dimensions:
        if d == "length":
            value = F.octet_length(plain).cast("double")
        elif d not in docs.columns:
            value = F.lit(0.0)
        elif docs.schema[d].dataType.typeName() in ("byte", "short", "integer", "long", "float", "double"):
            value = F.col(d).cast("double")
        else:
            value = F.crc32(F.col(d).cast("string").cast("binary")).cast("double")
        coordinates[f"at_{d}"] = F.coalesce(F.when(~F.isnan(value), value), F.lit(-1.0))
    rows = written(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            size.alias("size"),
            F.crc32(plain.cast("binary")).alias("text_crc32"),
            F.xxhash64(plain, F.octet_length(plain)).alias("group"),
            *[c.alias(n) for n, c in coordinates.items()],
        ),
        "shard-input",
    )
    total, count = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    total = float(total)
    leaves = shards or max(1, round(total / target_bytes))
    dims = len(dimensions)
    dealt, points = _points(rows, list(coordinates), max(total, 1.0) / leaves)
    points = written(points.withColumn("node", F.lit(0)), "shard-points")
    nodes = {0: (0, leaves)}  # node: first leaf, number of leaves
    extent: list[float] = []
    while any(n > 1 for _, n in nodes.values()):
        bounds = _bounds(points, dims)
        if not extent:
            extent = [(bounds[0][f"high{k}"] - bounds[0][f"low{k}"]) or 1.0 for k in range(dims)] if bounds else [1.0] * dims
        state, after = {}, {}
        for node, (first, n) in nodes.items():
            if n == 1 or node not in bounds:
                after[node] = (first, n if node in bounds else 1)
                continue
            b, left = bounds[node], n // 2
            dim = max(range(dims), key=lambda k: ((b[f"high{k}"] - b[f"low{k}"]) / extent[k], -k))
            state[node] = {"dim": dim, "on_tie": False, "at": 0.0, "low": b[f"low{dim}"], "high": b[f"high{dim}"], "below": 0.0}
            state[node]["wanted"] = b["weight"] * left / n
        if not state:
            break
        _refine(points, state, dims, max(total, 1.0) / leaves * TOLERANCE)
        rows_ = []
        for node, s in state.items():
            first, n = nodes[node]
            after[first], after[first + n // 2] = (first, n // 2), (first + n // 2, n - n // 2)
            rows_.append((node, s["dim"], s["cut"][0], s["cut"][1], s["inclusive"], first, first + n // 2))
        cuts = points.sparkSession.createDataFrame(
            rows_, "node int, dim int, cut double, cut_tie double, inclusive boolean, low_node int, high_node int"
        )
        x = _choose(cuts, dims)
        at_tie = F.when(F.col("inclusive"), F.col("tie") <= F.col("cut_tie")).otherwise(F.col("tie") < F.col("cut_tie"))
        at_cut = F.when(F.col("cut_tie").isNull(), F.col("inclusive")).otherwise(at_tie)
        goes_low = (x < F.col("cut")) | ((x == F.col("cut")) & at_cut)
        moved = points.join(F.broadcast(cuts), "node", "left").withColumn(
            "node", F.when(F.col("dim").isNull(), F.col("node")).when(goes_low, F.col("low_node")).otherwise(F.col("high_node"))
        )
        points = written(moved.select(*points.columns), "shard-points")
        nodes = after
    placed = dealt.join(points.select("group", "piece", F.col("node").alias("shard")), ["group", "piece"])
    return _with_slots(placed.select("doc_id", "size", "text_crc32", "shard"), max(LEAST_CHUNKS, -(-count // (CHUNK * leaves))))


def _with_slots(placed: DataFrame, chunks: int) -> DataFrame:
    """Number the rows of every shard from 0, alike in every run.

    Equal rows are one row with their count; these go to chunks by a hash of all they hold, so that null or repeated ids spread.
    Counts are added up within a chunk, then over the chunks before it, and many equal rows are written out by several tasks.
    """
    key = ["doc_id", "text_crc32", "size"]
    chunk = F.pmod(F.xxhash64(*key), F.lit(chunks)).alias("chunk")
    distinct = written(placed.groupBy(*key, "shard").agg(F.count(F.lit(1)).alias("n")).select("*", chunk), "shard-placed")
    ahead = W.partitionBy("shard").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    counts = distinct.groupBy("shard", "chunk").agg(F.sum("n").alias("held"))
    offsets = counts.select("shard", "chunk", F.coalesce(F.sum("held").over(ahead), F.lit(0)).alias("before"))
    inside = W.partitionBy("shard", "chunk").orderBy(*key).rowsBetween(W.unboundedPreceding, -1)
    numbered = distinct.withColumn("place", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(offsets, ["shard", "chunk"])
    numbered = written(numbered.select(*key, "shard", "n", (F.col("place") + F.col("before")).alias("first")), "shard-numbered")
    last = F.col("first") + F.col("n") - 1
    few = numbered.where(F.col("n") <= COPIES).select(*key, "shard", F.explode(F.sequence("first", last)).alias("slot"))
    pieces = numbered.where(F.col("n") > COPIES).select(
        *key, "shard", last.alias("last"), F.explode(F.sequence("first", last, F.lit(COPIES).cast("long"))).alias("from")
    )
    end = F.least(F.col("last"), F.col("from") + (COPIES - 1))
    many = pieces.repartition("shard", "from").select(*key, "shard", F.explode(F.sequence("from", end)).alias("slot"))
    return few.unionByName(many).select("doc_id", "size", "text_crc32", "shard", "slot")
