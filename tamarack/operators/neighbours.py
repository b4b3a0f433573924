"""Exact k nearest neighbours between two frames.

The base rows are cut into cells around pivots and every cell into blocks of bounded size. A
query first searches the blocks of its own cell; the k-th distance found there rules out, by
the triangle inequality, all cells that cannot hold a closer row (Lu et al., 2012, "Efficient
processing of k nearest neighbor joins using MapReduce"). Per query and block at most k
candidates leave a task. No candidate is dropped without that proof, so the result is exact.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamarack.operators.trees import columns_of, sent
from tamarack.session import cut_lineage

BLOCK = 4096

#: Distances that a task of a learning curve holds at a time, and groups of queries per slot.
CURVE_VALUES, CURVE_GROUPS = 1 << 22, 3
SLACK = 1e-9


def distances(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """All distances between the rows of two small blocks."""
    if metric == "euclidean":
        squares = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
        return np.sqrt(np.clip(squares, 0.0, None))
    out = np.empty((len(a), len(b)))
    for i, row in enumerate(a):
        gap = np.abs(b - row)
        out[i] = gap.sum(1) if metric == "manhattan" else gap.max(1)
    return out


def _rowwise(row: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    gap = np.abs(b - row)
    if metric == "euclidean":
        return np.sqrt((gap * gap).sum(1))
    return gap.sum(1) if metric == "manhattan" else gap.max(1)


def _closest(queries: pd.DataFrame, base: pd.DataFrame, k: int, metric: str, skip_self: bool) -> pd.DataFrame:
    """The k closest base rows of each query within one block, ties by neighbour id."""
    columns = ["query_id", "neighbour_id", "distance", "payload"]
    if not len(queries) or not len(base):
        return pd.DataFrame(columns=columns)
    a, b = np.stack(queries["_f"].to_numpy()), np.stack(base["_f"].to_numpy())
    ids, payload = base["neighbour_id"].to_numpy(), base["payload"].to_numpy()
    rough = distances(a, b, metric)
    bound = queries["bound"].fillna(np.inf).to_numpy()
    scale = 1.0 + np.sqrt((a * a).sum(1).max()) + np.sqrt((b * b).sum(1).max())
    found = []
    for i, query_id in enumerate(queries["query_id"].to_numpy()):
        row = rough[i]
        if skip_self:
            row = np.where(ids == query_id, np.inf, row)
        want = min(k, len(row))
        limit = np.partition(row, want - 1)[want - 1]
        near = np.nonzero((row <= min(limit, bound[i]) + 1e-6 * scale) & np.isfinite(row))[0]
        exact = _rowwise(a[i], b[near], metric)
        best = np.lexsort((ids[near], exact))[:want]  # none where all rows lie beyond the bound
        found.append((np.repeat(query_id, len(best)), ids[near][best], exact[best], payload[near][best]))
    return pd.DataFrame({c: np.concatenate([f[j] for f in found]) for j, c in enumerate(columns)})


def _top(df: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_id").orderBy("distance", "neighbour_id")
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


@dataclass
class KnnIndex:
    """Base rows by the cell of their closest pivot: (neighbour_id, _f, payload, cell, radius).

    ``stats`` has (rows, least radius, greatest radius) per cell that holds rows. Where ``rows`` is a table partitioned by
    cell, a search opens only the folders of the cells that its bounds leave.
    """

    centres: np.ndarray
    stats: dict[int, tuple[int, float, float]]
    rows: DataFrame
    metric: str = "euclidean"
    block: int = BLOCK
    partitioned: bool = False

    def pieces(self, counts: dict[int, int], cell: str) -> Column:
        """Pieces of at most about ``block`` rows, 0 for an empty cell."""
        return F.element_at(F.lit([-(-counts.get(c, 0) // self.block) for c in range(len(self.centres))]), F.col(cell) + 1)

    def piece(self) -> Column:
        held = {c: n for c, (n, _, _) in self.stats.items()}
        return F.pmod(F.xxhash64("neighbour_id"), self.pieces(held, "cell")).cast("int")

    def blocks(self, cells: list[int] | None) -> DataFrame:
        rows = self.rows if cells is None else self.rows.where(F.col("cell").isin(cells))
        return rows.select("cell", self.piece().alias("piece"), "neighbour_id", "_f", "payload")

    def written(self, path: str) -> KnnIndex:
        """The same index over a table at ``path``, one folder per cell, whose files hold a piece each."""
        if len(self.centres):
            self.rows.repartition("cell", self.piece()).write.partitionBy("cell").parquet(path)
        else:
            self.rows.write.parquet(path)
        schema = T.StructType([*[f for f in self.rows.schema if f.name != "cell"], self.rows.schema["cell"]])
        table = self.rows.sparkSession.read.schema(schema).parquet(path)
        return KnnIndex(self.centres, self.stats, table, self.metric, self.block, bool(len(self.centres)))


def _located(df: DataFrame, centres: np.ndarray, metric: str) -> DataFrame:
    """Adds the closest pivot's number and distance of the vector ``_f``."""

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                gap = distances(np.stack(pdf["_f"].to_numpy()), centres, metric)
                yield pdf.assign(cell=gap.argmin(1).astype("int32"), radius=gap.min(1))

    schema = T.StructType([*df.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("radius", T.DoubleType())])
    return df.mapInPandas(assign, schema)


def index_neighbours(
    base: DataFrame,
    base_id: str,
    features: str,
    metric: str = "euclidean",
    payload: str | None = None,
    pivots: int | None = None,
    block: int = BLOCK,
) -> KnnIndex:
    """Cells of the base rows; ``pivots`` is their number, by default an eighth of the root of the rows.

    Only the pivots and one row of statistics per cell reach the driver.
    """
    base_rows = base.select(
        F.col(base_id).cast("bigint").alias("neighbour_id"),
        F.col(features).cast("array<double>").alias("_f"),
        (F.col(payload) if payload else F.lit(0)).cast("double").alias("payload"),
    )
    count = pivots or max(1, int(base_rows.count() ** 0.5) // 8)
    picked = base_rows.orderBy(F.xxhash64("neighbour_id"), "neighbour_id").limit(count).select("_f").collect()
    centres = np.array([r["_f"] for r in picked])
    celled = _located(base_rows, centres, metric)
    if not picked:
        return KnnIndex(centres, {}, celled, metric, block)
    cells = celled.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.min("radius").alias("inner"), F.max("radius").alias("outer")
    ).collect()
    return KnnIndex(centres, {r["cell"]: (r["n"], r["inner"], r["outer"]) for r in cells}, celled, metric, block)


def knn(
    queries: DataFrame,
    base: DataFrame,
    k: int,
    query_id: str,
    base_id: str,
    features: str,
    metric: str = "euclidean",
    payload: str | None = None,
    skip_self: bool = False,
    pivots: int | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """(query_id, neighbour_id, distance, payload, rank) with the k closest base rows per query.

    ``features`` is an array<double> column of both frames; ids are integers; ``payload`` is a
    numeric base column to carry along, such as the label. ``pivots`` is the number of cells, by
    default an eighth of the root of the base rows; only the pivots and one row of statistics per
    cell reach the driver. Queries are taken in pieces of their home cell, and a block of base
    rows is sent only to the pieces some query of which must look into its cell.
    """
    return search_index(index_neighbours(base, base_id, features, metric, payload, pivots, block), queries, k, query_id, features, skip_self)


def search_index(
    index: KnnIndex, queries: DataFrame, k: int, query_id: str, features: str, skip_self: bool = False
) -> DataFrame:
    """:func:`knn` over an index that is at hand."""
    query_rows = queries.select(F.col(query_id).alias("query_id"), F.col(features).cast("array<double>").alias("_f"))
    centres, stats, metric, pieces = index.centres, index.stats, index.metric, index.pieces
    if not len(centres):
        return query_rows.select("query_id").where("false").withColumns(
            {"neighbour_id": F.lit(None).cast("bigint"), "distance": F.lit(0.0), "payload": F.lit(0.0), "rank": F.lit(0)}
        )
    located = _located(query_rows, centres, metric)
    asked = {r["cell"]: r["count"] for r in located.groupBy("cell").count().collect()}
    part = F.pmod(F.xxhash64("query_id"), pieces(asked, "cell")).cast("int")
    home = located.select("query_id", "_f", F.col("cell").alias("home"), part.alias("part"))

    def search(routed: DataFrame, cells: list[int] | None) -> DataFrame:
        """``routed`` has query_id, _f, home, part, bound and the cells to look into; it is read twice."""
        held = {c: n for c, (n, _, _) in stats.items()}

        def visits(*columns: str) -> DataFrame:
            looked = routed.select(*columns, "home", "part", F.explode("cells").alias("cell"))
            looked = looked.withColumn("_pieces", pieces(held, "cell")).where(F.col("_pieces") > 0)
            return looked.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1))).drop("_pieces")

        block_key = ["cell", "piece", "home", "part"]
        wanted = visits().select(*[F.col(c).alias(f"_{c}") for c in block_key]).distinct().toDF(*block_key)
        return (
            visits("query_id", "_f", "bound")
            .groupBy(*block_key)
            .cogroup(index.blocks(cells).join(wanted, ["cell", "piece"]).groupBy(*block_key))
            .applyInPandas(
                lambda q, b: _closest(q, b, k, metric, skip_self),
                "query_id bigint, neighbour_id bigint, distance double, payload double",
            )
        )

    own_cell = home.withColumns({"cells": F.array("home"), "bound": F.lit(None).cast("double")})
    first = cut_lineage(_top(search(own_cell, list(asked) if index.partitioned else None), k))
    bound = first.groupBy("query_id").agg(
        F.max(F.when(F.col("rank") == k, F.col("distance"))).alias("bound")
    )
    between = distances(centres, centres, metric)

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        inner = np.array([stats.get(c, (0, np.inf, -np.inf))[1] for c in range(len(centres))])
        outer = np.array([stats.get(c, (0, np.inf, -np.inf))[2] for c in range(len(centres))])
        for pdf in batches:
            if not len(pdf):
                continue
            gap = distances(np.stack(pdf["_f"].to_numpy()), centres, metric)
            own = pdf["home"].to_numpy()
            least = np.maximum(np.maximum(gap - outer, inner - gap), 0.0)
            if metric == "euclidean":
                own_gap = gap[np.arange(len(pdf)), own][:, None]
                apart = between[own]
                plane = (gap**2 - own_gap**2) / (2 * np.where(apart > 0, apart, np.inf))
                least = np.maximum(least, plane)
            limit = pdf["bound"].fillna(np.inf).to_numpy()[:, None]
            go = least <= limit * (1 + SLACK) + 1e-6
            go[np.arange(len(pdf)), own] = False
            yield pdf.assign(cells=[np.nonzero(g)[0].astype("int32") for g in go])

    routed = home.join(bound, "query_id", "left").select("query_id", "_f", "home", "part", "bound")
    schema = T.StructType([*routed.schema.fields, T.StructField("cells", T.ArrayType(T.IntegerType()))])
    routed = cut_lineage(routed.mapInPandas(route, schema))
    left = None
    if index.partitioned:
        left = [r["c"] for r in routed.select(F.explode("cells").alias("c")).distinct().collect()]
    return _top(first.drop("rank").unionByName(search(routed, left)), k)


def knn_classify(
    queries: DataFrame,
    train: DataFrame,
    query_id: str,
    train_id: str,
    features: str,
    label: str,
    k: int = 5,
    weighting: str = "distance",
    metric: str = "euclidean",
) -> DataFrame:
    """(query_id, prediction, probability) for a 0/1 label.

    Votes weigh 1/distance; where a neighbour coincides with the query only such neighbours vote.
    """
    return vote(knn(queries, train, k, query_id, train_id, features, metric, payload=label), query_id, weighting)


def vote(found: DataFrame, query_id: str, weighting: str = "distance") -> DataFrame:
    """(query_id, prediction, probability) from found neighbours whose payload is a 0/1 label."""
    exact = F.max((F.col("distance") == 0).cast("int")).over(W.partitionBy("query_id")) == 1
    weight = F.lit(1.0)
    if weighting == "distance":
        weight = F.when(exact, (F.col("distance") == 0).cast("double")).otherwise(F.try_divide(F.lit(1.0), F.col("distance")))
    votes = found.withColumn("_vote", weight).groupBy("query_id").agg(
        (F.sum(F.col("_vote") * F.col("payload")) / F.sum("_vote")).alias("probability")
    )
    return votes.select(
        F.col("query_id").alias(query_id), (F.col("probability") > 0.5).cast("double").alias("prediction"), "probability"
    )


def votes_at(found: DataFrame, query_id: str, votes: Sequence[tuple[int, str]]) -> DataFrame:
    """(query_id, said): the predictions of :func:`vote` for every (k, weighting), from the neighbours of the largest k."""
    exact = F.max((F.col("distance") == 0).cast("int")).over(W.partitionBy("query_id")) == 1
    near = F.when(exact, (F.col("distance") == 0).cast("double")).otherwise(F.try_divide(F.lit(1.0), F.col("distance")))
    weighed = found.withColumn("_near", near)
    said = []
    for k, weighting in votes:
        weight = F.when(F.col("rank") <= k, F.col("_near") if weighting == "distance" else F.lit(1.0))
        said.append((F.sum(weight * F.col("payload")) / F.sum(weight) > 0.5).cast("int"))
    return weighed.groupBy(F.col("query_id").alias(query_id)).agg(F.array(*said).alias("said"))


def _near(rough: np.ndarray, starts: np.ndarray, k: int, slack: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k closest columns of every row in each cell of columns, and of all that rounding might put among them."""
    pairs = []
    for low, high in zip(starts[:-1], starts[1:]):
        part = rough[:, low:high]
        limit = np.partition(part, k - 1, axis=1)[:, k - 1 : k] + slack if high - low > k else np.inf
        row, at = np.nonzero(part <= limit)
        pairs.append((row, at + low))
    return tuple(np.concatenate(v) for v in zip(*pairs))


def curve_cells(
    table: DataFrame, id_col: str, label: str, features: str, k: int, weighting: str, metric: str, fits: Sequence[tuple[float, int]]
) -> list[tuple[int, ...]]:
    """Per fit (share, fold): tn, fp, fn, tp of k nearest neighbours on its training rows, then on its fold; ``table`` has ``fold`` and ``place``.

    All fits share the distances: a row's k nearest among the training rows of a fit are among its k nearest in every cell of rows of
    one fold that enter at the same share. A task holds all rows and asks for a part of them, a block at a time.
    """
    groups = CURVE_GROUPS * table.sparkSession.sparkContext.defaultParallelism
    shares = np.unique([share for share, _ in fits])
    rows = sent(table, id_col, label, features, F.col("fold"), F.col("place"))

    def score(key: tuple, part: pa.Table) -> pa.Table:
        order, y, folds, place, _, x = columns_of(part)
        x = x[order].astype(float)
        band = np.searchsorted(shares, place, side="right")  # the first share that the row belongs to
        cell = folds.astype(np.int64) * (len(shares) + 1) + band
        by_cell = np.argsort(cell, kind="stable")
        x, y, folds, place, cell = x[by_cell], y[by_cell] > 0.5, folds[by_cell], place[by_cell], cell[by_cell]
        number = by_cell  # rows were in the order of their ids
        used = np.flatnonzero(place < shares[-1])
        starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        mine = np.flatnonzero(number % groups == key[0].as_py())
        counts = np.zeros((len(fits), 8), np.int64)
        step = max(1, CURVE_VALUES // max(1, len(y)))
        slack = 1e-6 * (1.0 + 2 * np.sqrt((x * x).sum(1).max()))
        for low in range(0, len(mine) if len(used) else 0, step):
            ask = mine[low : low + step]
            row, at = _near(distances(x[ask], x, metric), np.append(starts, len(y)), k, slack)
            gap = np.empty(len(row))
            for a in range(0, len(row), BLOCK):
                apart = x[at[a : a + BLOCK]] - x[ask[row[a : a + BLOCK]]]
                gap[a : a + BLOCK] = _rowwise(np.zeros(x.shape[1]), apart, metric)
            best = np.lexsort((number[at], gap, row))
            row, at, gap = row[best], at[best], gap[best]
            for i, (share, fold) in enumerate(fits):
                may = np.flatnonzero((folds[at] != fold) & (place[at] < share))
                first = np.searchsorted(row[may], np.arange(len(ask)))
                may = may[np.arange(len(may)) - first[row[may]] < k]
                of, near = row[may], gap[may]
                weight = np.ones(len(may))
                if weighting == "distance":
                    same = near == 0
                    hit = np.bincount(of, same, len(ask)) > 0
                    weight = np.where(hit[of], same, 1.0 / np.where(same, 1.0, near))
                whole, ones = np.bincount(of, weight, len(ask)), np.bincount(of, weight * y[at[may]], len(ask))
                known = whole > 0
                says = np.divide(ones, whole, out=np.zeros(len(ask)), where=known) > 0.5
                seen, fresh = known & (folds[ask] != fold) & (place[ask] < share), known & (folds[ask] == fold)
                counts[i] += np.concatenate([np.bincount(2 * y[ask][t] + says[t], minlength=4) for t in (seen, fresh)])
        return pa.table({"fit": pa.array(range(len(fits)), pa.int32()), "cells": pa.array(counts.tolist(), pa.list_(pa.int64()))})

    copies = rows.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    found = copies.repartitionByRange(groups, "group").groupBy("group").applyInArrow(score, "fit int, cells array<bigint>")
    out = np.zeros((len(fits), 8), np.int64)
    for r in found.groupBy("fit").agg(F.array(*[F.sum(F.get("cells", F.lit(i))) for i in range(8)]).alias("cells")).collect():
        out[r["fit"]] = r["cells"]
    return [tuple(row) for row in out.tolist()]
