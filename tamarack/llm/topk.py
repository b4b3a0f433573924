"""Exact top-k inner-product search by columnar branch and bound.

Rows are dealt into cells of a bounded number of queries and candidates. Within a cell the candidates lie dimension by dimension,
the dimensions of most energy first; scores are summed block of dimensions by block of dimensions, and after each block only the
candidates stay whose partial score plus the largest product that the remaining mass of both vectors allows can still reach the
k-th best score of some query at hand. Cells return k rows per query at most, of which the best k remain.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tamarack.llm.common import written

#: Most queries and candidates of a cell, fewest candidates worth a cell, queries scored together, first candidate chunk.
CELL_QUERIES, CELL_ROWS, LEAST_ROWS, TOGETHER, FIRST_CHUNK = 8192, 131_072, 4096, 64, 512

#: Dimensions per block.
BLOCK = 16


def integer_vector(column: str, scale: int = 64) -> Column:
    """floor(scale * x) of every component as a long; null if the vector is null or holds null or non-finite components."""
    x = F.transform(column, lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(F.col(column).isNotNull() & ~bad, F.transform(x, lambda v: F.floor(v * scale).cast("long")))


def _suffix_norms(rows: np.ndarray, borders: list[int]) -> np.ndarray:
    """Norms of what remains of each row after each block, rounded up; one line per block."""
    squares = (rows.astype(np.float64) ** 2).cumsum(axis=1)
    whole = squares[:, -1:] if squares.shape[1] else np.zeros((len(rows), 1))
    rest = [np.sqrt(np.maximum(whole[:, 0] - squares[:, b - 1], 0.0)) * (1 + 1e-9) + 1e-6 for b in borders]
    rest[-1] = np.zeros(len(rows))
    return np.array(rest)


def search_cell(
    query_ids: np.ndarray, queries: np.ndarray, row_ids: np.ndarray, rows: np.ndarray, k: int, block: int = BLOCK
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """query id, row id and score of the k best rows of each query, its own id left out, ties to smaller row ids."""
    none = np.zeros(0, np.int64)
    dims = queries.shape[1]
    if not len(query_ids) or not len(row_ids):
        return none, none, none
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(1, dims)
    kind = np.float64 if largest < 2**53 else np.int64
    order = np.argsort(-(rows.astype(np.float64) ** 2).sum(axis=0), kind="stable")
    by_id = np.argsort(row_ids, kind="stable")
    row_ids, rows = row_ids[by_id], rows[by_id][:, order]
    queries = queries[:, order]
    borders = [*range(block, dims, block), dims] if dims else []
    columns = np.ascontiguousarray(rows.T.astype(kind))  # vertical layout: one line per dimension
    row_rest = _suffix_norms(rows, borders) if dims else np.zeros((1, len(rows)))
    found = []
    for begin in range(0, len(query_ids), TOGETHER):
        ids = query_ids[begin : begin + TOGETHER]
        some = queries[begin : begin + TOGETHER].astype(kind)
        rest = _suffix_norms(queries[begin : begin + TOGETHER], borders) if dims else np.zeros((1, len(ids)))
        least = np.full(len(ids), -np.inf)
        best = (none, none, np.zeros(0, kind))  # query place, row id, score
        at, size = 0, FIRST_CHUNK
        while at < len(row_ids):
            alive = np.arange(at, min(len(row_ids), at + size))
            scores = np.zeros((len(ids), len(alive)), kind)
            low = 0
            for step, high in enumerate(borders):
                scores = scores + some[:, low:high] @ (columns[low:high, alive[0] : alive[-1] + 1] if len(alive) == alive[-1] + 1 - alive[0] else columns[low:high, alive])
                low = high
                if high < dims and np.isfinite(least).any():
                    reach = scores + np.outer(rest[step], row_rest[step][alive])
                    stay = (reach >= least[:, None]).any(axis=0)
                    if not stay.all():
                        alive, scores = alive[stay], scores[:, stay]
                    if not len(alive):
                        break
            if len(alive):
                place, col = np.nonzero((scores >= least[:, None]) & (row_ids[alive][None, :] != ids[:, None]))
                place = np.concatenate([best[0], place])
                cand = np.concatenate([best[1], row_ids[alive[col]]])
                value = np.concatenate([best[2], scores[place[len(best[0]) :], col]])
                sort = np.lexsort((cand, -value, place))
                place, cand, value = place[sort], cand[sort], value[sort]
                first = np.searchsorted(place, np.arange(len(ids) + 1))
                rank = np.arange(len(place)) - first[place]
                keep = rank < k
                best = (place[keep], cand[keep], value[keep])
                full = np.flatnonzero(np.diff(first) >= k)
                least[full] = value[first[full] + k - 1]
            at += size
            size = min(2 * size, 8192)
        found.append((ids[best[0]], best[1], best[2].astype(np.int64)))
    return tuple(np.concatenate([f[n] for f in found]) for n in range(3))


def _search_group(group: pa.Table, k: int) -> pa.Table:
    asks = group["asks"].to_numpy(zero_copy_only=False)
    ids = group["vec_id"].to_numpy()
    vectors = group["vector"].combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    matrix = flat.reshape(len(ids), -1) if len(flat) else np.zeros((len(ids), 0), np.int64)
    query, row, score = search_cell(ids[asks], matrix[asks], ids[~asks], matrix[~asks], k)
    return pa.table({"query_id": query, "vec_id": row, "score": score})


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, embedding: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k best rows of every row for which ``is_query`` holds.

    Takes vec_id and ``embedding``. Vectors that are null, or hold null or non-finite components, and rows without vec_id take
    no part; vectors meet only others of their length. A row with the query's own vec_id is no candidate. Fewer than k rows give
    fewer ranks; an empty table gives none.
    """
    spark = vectors.sparkSession
    flag = F.coalesce(is_query, F.lit(False))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), integer_vector(embedding).alias("vector"), flag.alias("asks"))
    rows = written(rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()), "vectors")
    n, asking = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("asks").cast("long")), F.lit(0))).first()
    down = max(1, -(-asking // CELL_QUERIES))
    slots = spark.sparkContext.defaultParallelism
    across = max(1, -(-n // CELL_ROWS), min(slots, -(-n // LEAST_ROWS)))
    length = F.size("vector").alias("length")
    candidates = rows.select(
        length,
        F.explode(F.sequence(F.lit(0), F.lit(down - 1))).alias("down"),
        F.pmod(F.xxhash64("vec_id"), F.lit(across)).cast("int").alias("across"),
        F.lit(False).alias("asks"),
        "vec_id",
        "vector",
    )
    queries = rows.where("asks").select(
        length,
        F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(down)).cast("int").alias("down"),
        F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("across"),
        F.lit(True).alias("asks"),
        "vec_id",
        "vector",
    )
    cells = candidates.unionByName(queries).groupBy("length", "down", "across")

    def run(group: pa.Table) -> pa.Table:
        return _search_group(group, k)

    near = cells.applyInArrow(run, "query_id long, vec_id long, score long")
    place = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
