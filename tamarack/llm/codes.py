"""Near duplicates among embeddings by randomly rotated binary codes.

1. Equal vectors are one class; a class is compared once.
2. Two random rotations turn a class's unit vector into two codes of signs. Each code is stored with its correction factor, the inner
   product of the rotated vector and its code. A code over its factor is an unbiased estimate of the vector, and as the two
   rotations are independent, the product of one class's first estimate and another's second is an unbiased estimate of their
   cosine. The factors also give the spread of the estimate, and so a confidence bound.
3. Slices of the first code are band keys; classes meet where a key is equal. The number of bands follows from the threshold: a pair
   right at it meets with probability ``recall``, closer pairs more surely. A pair counts in the first band in which it meets.
4. Bands ship codes, not vectors. Buckets of many classes are cut into blocks, and each pair of blocks is a task of bounded size.
   What cannot be a link by its bound ends there; classes that a possible link joins go on as small groups.
5. These groups fetch their vectors. Exact cosines in double precision decide; a group gives counts of links and a spanning forest,
   never its pairs, so that a large group of near copies costs comparisons but no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.llm.common import discard, written
from tamarack.llm.components import connected

#: Classes that a random bucket holds on average, classes per block of a large bucket, and classes dealt to a task together.
BUCKET, BLOCK, PACK = 256, 2048, 8192

#: Cells of a matrix of estimates or cosines that is held at once.
STRIPE = 2**19

#: Bits of a code at least; standard deviations that an estimate may be off before a pair is lost; seed of the rotations.
BITS, SPREADS, SEED = 256, 5.0, 20_240_521

#: Rows up to which the list of large buckets is broadcast (20 bytes each).
BROADCAST_ROWS = 1_000_000

_ROTATIONS: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}


def plan_bands(classes: int, threshold: float, recall: float) -> tuple[int, int]:
    """Bits of a band key and number of bands."""
    bits = min(48, max(4, math.ceil(math.log2(max(1, classes) / BUCKET))) if classes > BUCKET else 4)
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - agree))) if agree < 1 else 1


def code_bits(dims: int, key_bits: int, bands: int) -> int:
    """Bits of a code: enough for all bands to have their own, and a multiple of 64."""
    return -(-max(BITS, dims, key_bits * bands) // 64) * 64


def rotations(dims: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent random matrices of orthonormal columns, bits x dims: rotations of the zero-padded vector."""
    if (dims, bits) not in _ROTATIONS:
        _ROTATIONS.clear()
        rng = np.random.default_rng([SEED, dims, bits])
        _ROTATIONS[dims, bits] = tuple(np.linalg.qr(rng.standard_normal((bits, dims)))[0].astype(np.float32) for _ in range(2))
    return _ROTATIONS[dims, bits]


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows over their length, without overflow on the way."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True, initial=0)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def encode(rows: np.ndarray, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each rotation the packed signs of unit ``rows`` and their correction factors."""
    out = []
    for rotation in rotations(rows.shape[1], bits):
        turned = rows.astype(np.float32) @ rotation.T
        out.append((np.packbits(turned > 0, axis=1), np.abs(turned).sum(axis=1) / math.sqrt(bits)))
    return out


def decode(codes: np.ndarray, factors: np.ndarray, dims: int, which: int) -> np.ndarray:
    """Unbiased estimates of the vectors behind the codes of one rotation."""
    bits = codes.shape[1] * 8
    signs = np.unpackbits(codes, axis=1).astype(np.float32) * 2 - 1
    return (signs @ rotations(dims, bits)[which]) / (math.sqrt(bits) * factors[:, None])


def blur(factors: np.ndarray, bits: int) -> np.ndarray:
    """Standard deviation of one estimate's error in any direction."""
    return np.sqrt(np.maximum(0, 1 - factors**2)) / (factors * math.sqrt(max(1, bits - 1)))


def keys(codes: np.ndarray, key_bits: int, bands: int) -> np.ndarray:
    """Band keys of packed codes, one line per row."""
    signs = np.unpackbits(codes, axis=1)[:, : key_bits * bands].reshape(len(codes), bands, key_bits)
    return signs.astype(np.int64) @ (np.int64(1) << np.arange(key_bits, dtype=np.int64))


def _lists(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _bytes(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


_CODES = "class long, dims int, code1 binary, code2 binary, factor1 float, factor2 float, keys array<long>"


def _coded(batches: Iterator[pa.RecordBatch], key_bits: int, bands: int) -> Iterator[pa.RecordBatch]:
    """Codes, factors and band keys of classes, by length of the vectors."""
    names = ["class", "dims", "code1", "code2", "factor1", "factor2", "keys"]
    for batch in batches:
        sizes = batch.column("dims").to_numpy()
        for dims in np.unique(sizes):
            some = batch.take(pa.array(np.flatnonzero(sizes == dims)))
            bits = code_bits(int(dims), key_bits, bands)
            (c1, f1), (c2, f2) = encode(unit(_lists(some.column("vector"))), bits)
            own = keys(c1, key_bits, bands)
            borders = pa.array(np.arange(len(own) + 1, dtype=np.int32) * bands)
            yield pa.RecordBatch.from_arrays(
                [
                    some.column("class"), some.column("dims"), pa.array([c.tobytes() for c in c1], pa.binary()),
                    pa.array([c.tobytes() for c in c2], pa.binary()), pa.array(f1.astype(np.float32)),
                    pa.array(f2.astype(np.float32)), pa.ListArray.from_arrays(borders, pa.array(own.ravel())),
                ],
                names,
            )


class Forest:
    """Components of places 0 to n - 1, named by their smallest place, and the pairs that joined them."""

    def __init__(self, n: int) -> None:
        self.top, self.pairs = np.arange(n), []

    def add(self, left: np.ndarray, right: np.ndarray) -> None:
        while True:
            a, b = self.top[left], self.top[right]
            apart = a != b
            if not apart.any():
                return
            left, right, a, b = left[apart], right[apart], a[apart], b[apart]
            high, low = np.maximum(a, b), np.minimum(a, b)
            order = np.argsort(high, kind="stable")
            first = order[np.r_[True, np.diff(high[order]) != 0]]
            self.top[high[first]] = low[first]  # every root points to a smaller one: no circles
            self.pairs.append(np.stack([left[first], right[first]]))
            while (self.top != self.top[self.top]).any():
                self.top = self.top[self.top]

    def edges(self) -> np.ndarray:
        return np.concatenate(self.pairs, axis=1) if self.pairs else np.zeros((2, 0), np.int64)


def _stripes(low: np.ndarray, high: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of ``low`` that meet all of ``high`` in a matrix of bounded size."""
    step = max(1, STRIPE // max(1, len(high)))
    return ((at, min(len(low), at + step)) for at in range(0, len(low), step))


def _first_meeting(own: np.ndarray, low: np.ndarray, high: np.ndarray, band: int) -> np.ndarray:
    """Whether rows and columns agree in no band before this one."""
    fresh = np.ones((len(low), len(high)), bool)
    for k in range(band):
        fresh &= own[low, k][:, None] != own[high, k][None, :]
    return fresh


def _runs(order: np.ndarray, *columns: np.ndarray) -> Iterator[np.ndarray]:
    """Parts of ``order`` in which all columns are equal."""
    change = np.zeros(max(0, len(order) - 1), bool)
    for c in columns:
        change |= np.diff(c[order]) != 0
    return iter(np.split(order, np.flatnonzero(change) + 1)) if len(order) else iter(())


def _candidates(table: pa.Table, threshold: float, key_bits: int, bands: int) -> pa.Table:
    """Per bucket and tile of a pack, the classes that possible links join, as cells."""
    band, key, tile, side = (table[c].to_numpy() for c in ("band", "key", "tile", "side"))
    dims, codes1 = int(table["dims"][0].as_py()), table["code1"].combine_chunks()
    c1, c2 = _bytes(codes1), _bytes(table["code2"])
    f1, f2 = table["factor1"].to_numpy(), table["factor2"].to_numpy()
    bits = c1.shape[1] * 8
    first, second = decode(c1, f1, dims, 0), decode(c2, f2, dims, 1)
    w1, w2 = blur(f1, bits) ** 2, blur(f2, bits) ** 2
    own = keys(c1, key_bits, bands)
    cells, members, number = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    for here in _runs(np.lexsort((side, tile, key, band)), band, key, tile):
        within = tile[here[0]] % 2 == 0
        split = len(here) if within else int(np.searchsorted(side[here], 1))
        low, high = here[:split], here if within else here[split:]
        if len(here) < 2 or not len(low) or not len(high):
            continue
        forest = Forest(len(here))
        for begin, end in _stripes(low, high):
            some = low[begin:end]
            spread = np.sqrt(w1[some][:, None] + w2[high][None, :] + np.outer(w1[some], w2[high] * dims))
            maybe = first[some] @ second[high].T + SPREADS * spread >= threshold
            if within:
                maybe = np.triu(maybe, begin + 1)
            if maybe.any():
                a, b = np.nonzero(maybe & _first_meeting(own, some, high, int(band[here[0]])))
                forest.add(a + begin, b if within else b + split)
        joined = np.unique(forest.edges())
        if len(joined):
            names, place = np.unique(forest.top[joined], return_inverse=True)
            cells.append(number + place)
            members.append(here[joined])
            number += len(names)
    at = np.concatenate(members)
    return pa.table(
        {
            "pack": np.full(len(at), table["pack"][0].as_py(), np.int64), "cell": np.concatenate(cells), "band": band[at].astype(np.int32),
            "side": side[at].astype(np.int32), "within": tile[at] % 2 == 0, "class": table["class"].to_numpy()[at], "code1": codes1.take(pa.array(at)),
        }
    )


_MEMBERS = "pack long, cell long, band int, side int, within boolean, class long, code1 binary"


def _links(table: pa.Table, threshold: float, key_bits: int, bands: int) -> pa.Table:
    """(a, b, n): n links of class a (b null), or an edge of a spanning forest (n null)."""
    cell, names, copies = (table[c].to_numpy() for c in ("cell", "class", "copies"))
    band, side, within = (table[c].to_numpy(zero_copy_only=False) for c in ("band", "side", "within"))
    vectors = unit(_lists(table["vector"]))
    own = keys(_bytes(table["code1"]), key_bits, bands)
    total, edges = np.zeros(len(cell), np.int64), [np.zeros((2, 0), np.int64)]
    for here in _runs(np.lexsort((side, cell)), cell):
        alone = bool(within[here[0]])
        split = len(here) if alone else int(np.searchsorted(side[here], 1))
        low, high = here[:split], here if alone else here[split:]
        forest = Forest(len(here))
        for begin, end in _stripes(low, high):
            some = low[begin:end]
            linked = vectors[some] @ vectors[high].T >= threshold
            linked &= _first_meeting(own, some, high, int(band[here[0]]))
            if alone:
                linked = np.triu(linked, begin + 1)
            total[some] += linked @ copies[high]
            total[high] += copies[some] @ linked
            a, b = np.nonzero(linked)
            forest.add(a + begin, b if alone else b + split)
        edges.append(names[here[forest.edges()]])
    left, right = np.concatenate(edges, axis=1)
    some = total > 0
    return pa.table(
        {
            "a": np.concatenate([names[some], left]),
            "b": pa.concat_arrays([pa.nulls(int(some.sum()), pa.int64()), pa.array(right)]),
            "n": pa.concat_arrays([pa.array(total[some]), pa.nulls(len(left), pa.int64())]),
        }
    )


def vector_or_null(embedding: str) -> Column:
    """The components as doubles; null for vectors that are null, empty, zero, or hold null or non-finite components."""
    x = F.transform(embedding, lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(F.col(embedding).isNotNull() & ~bad & F.exists(x, lambda v: v != 0), x)


def near_embeddings(vectors: DataFrame, threshold: float = 0.9, recall: float = 0.99, embedding: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id and kept of every row; links are pairs of rows with cosine >= ``threshold`` (above zero).

    No pair below the threshold is linked. A pair right at the threshold is found with probability ``recall`` or more, closer pairs
    more surely; equal vectors always. Vectors that are null, empty, zero, or hold null or non-finite components link with
    nothing, nor do vectors of different lengths with each other. Rows without vec_id link with nothing and are no link of others;
    their component_id is null and they are kept. Rows that repeat a vec_id are rows like any other: they share the component's
    smallest vec_id. Other columns of the table are not read.
    """
    x = vector_or_null(embedding)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(F.col("vec_id").isNotNull(), x).alias("vector"))
    hashes = {f"h{k}": F.when(F.col("vector").isNotNull(), F.xxhash64("vector", F.lit(k))) for k in (1, 2)}
    rows = written(rows.withColumns(hashes), "vectors")
    classes = rows.where("vector IS NOT NULL").groupBy("h1", "h2").agg(
        F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector")
    )
    classes = classes.select("*", F.size("vector").alias("dims"), F.monotonically_increasing_id().alias("class"))
    classes = written(classes, "classes")
    key_bits, bands = plan_bands(classes.count(), threshold, recall)
    coded = classes.select("class", "dims", "vector").mapInArrow(lambda b: _coded(b, key_bits, bands), _CODES)
    coded = written(coded, "codes")

    met = coded.select("dims", F.posexplode("keys").alias("band", "key"))
    large = written(met.groupBy("dims", "band", "key").count().where(F.col("count") > BLOCK), "large")
    n_large = large.count()
    packs = max(1, -(-(coded.count() * bands) // PACK))
    rest = coded.select("dims", "class", "code1", "code2", "factor1", "factor2", F.posexplode("keys").alias("band", "key"))
    if n_large:
        rest = rest.join(F.broadcast(large) if n_large <= BROADCAST_ROWS else large, ["dims", "band", "key"], "left")
        rest = rest.withColumn("blocks", F.ceil(F.coalesce("count", F.lit(1)) / BLOCK).cast("int"))
    else:
        rest = rest.withColumn("blocks", F.lit(1))
    # tile 2 * block is a block with itself; tile 2 * (low * blocks + high) + 1 is two blocks
    block = F.pmod(F.xxhash64("class", F.lit(SEED)), F.col("blocks")).cast("long")
    rest = rest.withColumn("block", block)
    others = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1),
        lambda o: F.struct(
            F.when(o == F.col("block"), 2 * o)
            .otherwise(2 * (F.least(o, F.col("block")) * F.col("blocks") + F.greatest(o, F.col("block"))) + 1).alias("tile"),
            F.when(o < F.col("block"), 1).otherwise(0).alias("side"),
        ),
    )
    rest = rest.withColumn("place", F.explode(others)).select("*", "place.*").drop("place", "count", "block")
    pack = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("band", "key"), F.lit(packs))).otherwise(
        F.xxhash64("band", "key", "tile").bitwiseOR(F.lit(1 << 62))
    )
    tiles = rest.withColumn("pack", pack).drop("blocks")
    found = tiles.groupBy("dims", "pack").applyInArrow(lambda t: _candidates(t, threshold, key_bits, bands), _MEMBERS)
    found = written(found, "candidates")
    fetched = found.join(classes.select("class", "vector", "copies", "dims"), "class")
    exact = fetched.groupBy("dims", "pack").applyInArrow(lambda t: _links(t, threshold, key_bits, bands), "a long, b long, n long")
    exact = written(exact, "links")
    counts = exact.where("n IS NOT NULL").groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("n"))
    parts = connected(exact.where("b IS NOT NULL").select("a", "b"), "a", "b").withColumnRenamed("node", "class")
    by_class = classes.select("class", "h1", "h2", "least", "copies").join(counts, "class", "left").join(parts, "class", "left")
    by_class = written(by_class.withColumn("component", F.coalesce("component", "class")), "by-class")
    tops = by_class.groupBy("component").agg(F.min("least").alias("component_id"))
    by_class = written(by_class.join(tops, "component").select("h1", "h2", "component_id", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links")), "result")
    out = rows.select("vec_id", "h1", "h2").join(by_class, ["h1", "h2"], "left")
    component = F.coalesce("component_id", "vec_id")
    out = out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
    discard(coded, large, found, exact)
    return out
