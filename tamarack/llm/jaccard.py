"""Exact near-duplicate groups by n-gram Jaccard similarity: size-banded tiles with hashed bitmap signatures.

1. Texts with equal shingle sets are one class, named by its smallest doc_id.
2. MinHash bands give every class one likely partner; exact intersections confirm it. This only spares work below: most copies are
   in one component by now.
3. A class's rarest shingles (a quarter of them and one) must hold a shingle of each class it can link to. Shingles that hold
   classes of two components or more open tiles: the classes that hold one, by bands of set size, in blocks of bounded size. In a
   tile, bitmaps are compared: bits in which two differ are shingles that only one has, so their number bounds the overlap from
   above. What passes, between different components, goes to exact intersection of the sorted arrays.
4. Tiles first give the best partner of each class in each other component, then, with the components joined, all that is left.
   A shingle of a few classes only needs no tile: its pairs of fitting size are told apart first and compared once each.

No pair above the threshold can be missed; no pair within a component is ever formed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.llm.common import discard, list_column, mix, shingle_sets, signed, tidied, written
from tamarack.llm.components import connected

#: Words per shingle; links ask for 100 * intersection >= 75 * union.
WIDTH, PERCENT = 5, 75

#: MinHash bands, and hashes per band.
BANDS, ROWS = 8, 3

#: Shingles counted at once for the order of rarity, least count in them that is noted, and most shingles that are noted at all. The order
#: decides how much work there is, never the result.
COUNTED, NOTED, FREQUENT = 2**21, 4, 2**18

#: Rare shingles packed at once.
PACKED = 2**20

#: Lists of classes up to this are compared without a tile.
SHORT = 64

#: Classes per block of a tile; bits of the filter for shared shingles; rows up to which class tables are broadcast.
BLOCK, FILTER_BITS, BROADCAST_ROWS = 2048, 2**26, 2_000_000

_SALTS = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)) | np.uint64(1)


@tidied
def _first_pass(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """kind 0: doc_id, set size, two hashes of the set, MinHash bands; kind 1: shingles that are frequent here, with counts."""
    held: list[np.ndarray] = []
    waiting = 0

    def rows(length: int, kind: int, **columns: pa.Array) -> pa.RecordBatch:
        types = {"doc_id": pa.int64(), "n": pa.int64(), "h1": pa.int64(), "h2": pa.int64(), "bands": pa.list_(pa.int64()), "token": pa.int64(), "count": pa.int64()}
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(length, kind, np.int32)), *(columns.get(c, pa.nulls(length, t)) for c, t in types.items())], ["kind", *types]
        )

    def noted() -> Iterator[pa.RecordBatch]:
        token = np.concatenate(held)
        held.clear()
        token.sort()
        first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]])) if len(token) else np.zeros(0, np.int64)
        count = np.diff(np.append(first, len(token)))
        token, count = token[first[count >= NOTED]], count[count >= NOTED]
        if len(token):
            yield rows(len(token), 1, token=pa.array(signed(token)), count=pa.array(count.astype(np.int64)))

    for batch in batches:
        ids = batch.column(0)
        for row, values, sizes in shingle_sets(batch.column(1), width):
            starts = np.cumsum(sizes) - sizes
            full = np.flatnonzero(sizes)
            h1, h2 = np.zeros(len(sizes), np.uint64), np.zeros(len(sizes), np.uint64)
            bands = np.zeros((len(sizes), BANDS), np.uint64)
            if len(full):
                h1[full] = np.add.reduceat(mix(values), starts[full])
                h2[full] = np.add.reduceat(mix(values ^ np.uint64(0x5851F42D4C957F2D)), starts[full])
                for k, salt in enumerate(_SALTS):
                    low = np.minimum.reduceat(values * salt, starts[full])
                    bands[full, k // ROWS] = mix(bands[full, k // ROWS] ^ low)
            yield rows(
                len(sizes), 0, doc_id=ids[row : row + len(sizes)].cast(pa.int64()), n=pa.array(sizes), h1=pa.array(signed(h1)),
                h2=pa.array(signed(h2)), bands=list_column(signed(bands.ravel()), np.full(len(sizes), BANDS)),
            )
            held.append(values)
            waiting += len(values)
            if waiting >= COUNTED:
                yield from noted()
                waiting = 0
    if held:
        yield from noted()


def _prefixes(values: np.ndarray, sizes: np.ndarray, tokens: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rarest shingles of each set, as many as any linked set must share one of, and whose they are."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    common = np.zeros(len(values), np.int64)
    if len(tokens):
        maybe = np.zeros(2**16, bool)
        maybe[(tokens >> np.uint64(48)).astype(np.int64)] = True
        at = np.flatnonzero(maybe[(values >> np.uint64(48)).astype(np.int64)])
        spot = np.minimum(np.searchsorted(tokens, values[at]), len(tokens) - 1)
        common[at] = np.where(tokens[spot] == values[at], counts[spot], 0)
    order = np.lexsort((values, common, owner))
    values, owner = values[order], owner[order]
    rank = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    wanted = sizes - -(-sizes * PERCENT // 100) + 1
    keep = rank < wanted[owner]
    return values[keep], owner[keep]


@tidied
def _shared_batches(
    batches: Iterator[pa.RecordBatch], width: int, buckets: int, tokens: np.ndarray, counts: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """(part, data): rare shingles and components of the classes, once per pair in a piece, packed per bucket."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    waiting = 0

    def flush() -> pa.RecordBatch:
        token = np.concatenate([h[0] for h in held])
        component = np.concatenate([h[1] for h in held])
        held.clear()
        order = np.lexsort((component, token))
        token, component = token[order], component[order]
        fresh = np.ones(len(token), bool)
        fresh[1:] = (token[1:] != token[:-1]) | (component[1:] != component[:-1])
        token, component = token[fresh], component[fresh]
        part = (token % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        token, component = token[order], component[order]
        edges = np.searchsorted(part[order], np.arange(buckets + 1))
        used = [b for b in range(buckets) if edges[b] < edges[b + 1]]
        kind = np.uint32 if len(component) and component.min() >= 0 and component.max() < 2**32 else np.int64
        data = []
        for b in used:
            span = slice(edges[b], edges[b + 1])
            data.append(bytes([np.dtype(kind).itemsize]) + token[span].tobytes() + component[span].astype(kind).tobytes())
        return pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(data, pa.binary())], ["part", "data"])

    for batch in batches:
        component = batch.column(2).to_numpy()
        for row, values, sizes in shingle_sets(batch.column(0), width):
            token, owner = _prefixes(values, sizes, tokens, counts)
            held.append((token, component[row : row + len(sizes)][owner]))
            waiting += len(token)
            if waiting >= PACKED:
                yield flush()
                waiting = 0
    if held:
        yield flush()


def _filter_bits(group: pa.Table, buckets: int, bits: int) -> pa.Table:
    """Bits of the shingles of a bucket that classes of two components or more hold."""
    token, component = [], []
    for data in group["data"]:
        raw = data.as_py()
        n = (len(raw) - 1) // (8 + raw[0])
        token.append(np.frombuffer(raw, np.uint64, n, 1))
        component.append(np.frombuffer(raw, np.uint32 if raw[0] == 4 else np.int64, n, 1 + 8 * n).astype(np.int64))
    token, component = np.concatenate(token), np.concatenate(component)
    order = np.argsort(token, kind="stable")
    token, component = token[order], component[order]
    differs = (token[1:] == token[:-1])
    first = np.flatnonzero(np.concatenate([[True], ~differs]))
    mixed = np.minimum.reduceat(component, first) != np.maximum.reduceat(component, first)
    out = np.zeros(bits, bool)
    out[((token[first][mixed] // np.uint64(buckets)) % np.uint64(bits)).astype(np.int64)] = True
    return pa.table({"part": pa.array([group["part"][0].as_py()], pa.int32()), "data": pa.array([np.packbits(out, bitorder="little").tobytes()], pa.binary())})


@tidied
def _entry_batches(
    batches: Iterator[pa.RecordBatch], width: int, buckets: int, tokens: np.ndarray, counts: np.ndarray, bits: int, kept: dict[int, bytes]
) -> Iterator[pa.RecordBatch]:
    """(token, class, component, n) of the rare shingles that pass the filter."""
    table = np.zeros((buckets, bits // 8), np.uint8)
    for part, data in kept.items():
        table[part] = np.frombuffer(data, np.uint8)
    for batch in batches:
        for row, values, sizes in shingle_sets(batch.column(0), width):
            token, owner = _prefixes(values, sizes, tokens, counts)
            part = (token % np.uint64(buckets)).astype(np.int64)
            bit = ((token // np.uint64(buckets)) % np.uint64(bits)).astype(np.int64)
            hit = (table[part, bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool)
            whose = pa.array(row + owner[hit])
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(token[hit])), *(batch.column(k).take(whose) for k in (1, 2, 3))], ["token", "class", "component", "n"]
            )


def bitmap(values: np.ndarray) -> bytes:
    """Parity of the number of shingles per bit, about four to eight bits per shingle, a power of two."""
    width = max(64, 1 << int(4 * len(values) - 1).bit_length())
    odd = np.bincount((values & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


@tidied
def _bitmap_batches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, values, sizes in shingle_sets(batch.column(0), width):
            edges = np.concatenate([[0], np.cumsum(sizes)])
            maps = [bitmap(values[edges[k] : edges[k + 1]]) for k in range(len(sizes))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1)[row : row + len(sizes)], pa.array(sizes), pa.array(maps, pa.binary())], ["class", "n", "bits"]
            )


@tidied
def _array_batches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Text, key columns... to key columns and the sorted shingle array as bytes."""
    for batch in batches:
        names = batch.schema.names[1:]
        for row, values, sizes in shingle_sets(batch.column(0), width):
            edges = np.concatenate([[0], np.cumsum(sizes)])
            packed = [values[edges[k] : edges[k + 1]].tobytes() for k in range(len(sizes))]
            keys = [batch.column(k + 1)[row : row + len(sizes)] for k in range(len(names))]
            for at in range(0, len(packed), 256):
                yield pa.RecordBatch.from_arrays([*(k[at : at + 256] for k in keys), pa.array(packed[at : at + 256], pa.binary())], [*names, "shingles"])


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays of distinct numbers."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    return int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())


@tidied
def _linked_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for left, right in zip(batch.column(2), batch.column(3)):
            a, b = np.frombuffer(left.as_py(), np.uint64), np.frombuffer(right.as_py(), np.uint64)
            shared = overlap(a, b)
            keep.append(100 * shared >= PERCENT * (len(a) + len(b) - shared))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))


@tidied
def _near_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs with sizes and bitmaps: those whose bitmaps let them through."""
    for batch in batches:
        keep = []
        for n, left, right in zip(batch.column(2).to_pylist(), batch.column(3), batch.column(4)):
            a, b = left.as_py(), right.as_py()
            width = min(len(a), len(b)) * 8
            apart = int(np.bitwise_count(_fold(a, width) ^ _fold(b, width)).sum())
            keep.append((100 + PERCENT) * (n - apart) >= 2 * PERCENT * n)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _fold(raw: bytes, width: int) -> np.ndarray:
    bits = np.frombuffer(raw, np.uint8)
    while len(bits) * 8 > width:
        bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
    return bits


def _tile_pairs(side: np.ndarray, classes: np.ndarray, comp: np.ndarray, n: np.ndarray, band: np.ndarray, bits: list[bytes], best: bool) -> Iterator[tuple]:
    """Pairs of a tile that the bitmaps let through: left rows against right rows of other components and fitting size."""
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if not len(left) or not len(right) or (comp == comp[0]).all():
        return
    width = min(len(b) for b in bits) * 8
    maps = np.stack([_fold(b, width) for b in bits]).view(np.uint64)
    step = max(1, 2**21 // (len(right) * maps.shape[1]))
    for at in range(0, len(left), step):
        x = left[at : at + step]
        total = n[x][:, None] + n[right][None, :]
        fits = (comp[x][:, None] != comp[right][None, :]) & (100 * np.minimum.outer(n[x], n[right]) >= PERCENT * np.maximum.outer(n[x], n[right]))
        fits &= (band[x][:, None] != band[right][None, :]) | (classes[x][:, None] < classes[right][None, :])  # each pair once
        i, j = np.nonzero(fits)
        if not len(i):
            continue
        apart = np.bitwise_count(maps[x][i] ^ maps[right][j]).sum(axis=1).astype(np.int64) if len(i) * maps.shape[1] < 2**22 else np.concatenate(
            [np.bitwise_count(maps[x[i[s : s + 65536]]] ^ maps[right[j[s : s + 65536]]]).sum(axis=1).astype(np.int64) for s in range(0, len(i), 65536)]
        )
        # with apart bits or more between them, 2 * intersection <= total - apart
        passed = (100 + PERCENT) * (total[i, j] - apart) >= 2 * PERCENT * total[i, j]
        i, j, apart = i[passed], j[passed], apart[passed]
        if best and len(i):
            order = np.lexsort((apart, comp[right[j]], i))
            i, j = i[order], j[order]
            fresh = np.ones(len(i), bool)
            fresh[1:] = (i[1:] != i[:-1]) | (comp[right[j]][1:] != comp[right[j]][:-1])
            i, j = i[fresh], j[fresh]
        yield classes[x[i]], classes[right[j]]


@tidied
def _tile_batches(batches: Iterator[pa.RecordBatch], best: bool) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by tile; a tile may span batches."""
    held: list[pa.RecordBatch] = []

    def done(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        if not rows.num_rows:
            return
        tile, side, classes, comp, n, band = (rows.column(k).to_numpy() for k in range(6))
        bits = rows.column(6)
        edges = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1], [True]]))
        found = []
        for a, b in zip(edges[:-1], edges[1:]):
            if b - a < 2 or (comp[a:b] == comp[a]).all():
                continue
            maps = [v.as_py() for v in bits[a:b]]
            found += _tile_pairs(side[a:b], classes[a:b], comp[a:b], n[a:b], band[a:b], maps, best)
        if found:
            x, y = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
            pairs = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[1]), pa.array(pairs[0])], ["a", "b"])

    for batch in batches:
        if not len(batch):
            continue
        tile = batch.column(0).to_numpy()
        other = np.flatnonzero(tile != tile[-1])
        cut = int(other[-1]) + 1 if len(other) else 0  # the last tile may go on in the next batch
        if held and held[-1].column(0)[-1].as_py() != tile[0]:
            yield from done(pa.Table.from_batches(held))
            held = []
        if cut > 0:
            yield from done(pa.Table.from_batches([*held, batch.slice(0, cut)]))
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield from done(pa.Table.from_batches(held))


class JaccardJoin:
    """The steps of the join over one table of documents."""

    def __init__(self, docs: DataFrame, text: str = "text", width: int = WIDTH):
        self.spark, self.width = docs.sparkSession, width
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
        schema = "kind int, doc_id long, n long, h1 long, h2 long, bands array<long>, token long, count long"
        first = written(self.docs.mapInArrow(partial(_first_pass, width=width), schema), "shingles")
        self.rows = first.where("kind = 0").select("doc_id", "n", "h1", "h2")
        sets = first.where("kind = 0 AND n > 0 AND doc_id IS NOT NULL")
        classes = sets.groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("class"), F.first("bands").alias("bands"))
        self.classes = written(classes, "classes")
        frequent = first.where("kind = 1").groupBy("token").agg(F.sum("count").alias("count"))
        top = frequent.orderBy(F.desc("count"), "token").limit(FREQUENT).toArrow()
        tokens = top["token"].to_numpy().view(np.uint64)
        order = np.argsort(tokens)
        self.tokens, self.counts = tokens[order], top["count"].to_numpy()[order]
        size = self.classes.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        self.n_classes = size[0]
        self.buckets = max(16, -(-int(size[1]) // 8_000_000))
        self.bits = max(8, min(2**22, FILTER_BITS // self.buckets) // 8 * 8)

    def _bounded(self, small: DataFrame, rows: int) -> DataFrame:
        return F.broadcast(small) if rows <= BROADCAST_ROWS else small

    def _texts(self, keyed: DataFrame, key: str, rows: int) -> DataFrame:
        """Texts of classes with the other columns of ``keyed``, whose ``key`` is a class (its smallest doc_id)."""
        found = self.docs.where("doc_id IS NOT NULL").join(self._bounded(keyed, rows), F.col("doc_id") == F.col(key))
        return found.select("text", *keyed.columns)

    def confirm(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) of classes that exact intersection links. ``pairs`` is written."""
        n = pairs.count()
        if not n:
            return self.spark.createDataFrame([], "a long, b long")
        run = partial(_array_batches, width=self.width)
        left = self._texts(pairs, "a", n).mapInArrow(run, "a long, b long, shingles binary")
        hubs = pairs.select(F.col("b").alias("hub")).distinct()
        right = self._texts(hubs, "hub", n).mapInArrow(run, "hub long, shingles binary").withColumnRenamed("shingles", "other")
        joined = left.hint("merge").join(right.hint("merge"), F.col("b") == F.col("hub")).select("a", "b", "shingles", "other")
        return written(joined.mapInArrow(_linked_batches, "a long, b long").distinct(), "links")

    def likely(self) -> DataFrame:
        """One partner for each class, the smallest class of the MinHash bucket they share most often."""
        keyed = self.classes.select("class", F.posexplode("bands").alias("band", "key"))
        hubs = keyed.groupBy("band", "key").agg(F.min("class").alias("hub"), F.count(F.lit(1)).alias("held")).where("held > 1")
        met = keyed.join(hubs, ["band", "key"]).where("hub <> class").groupBy("class", "hub").agg(F.count(F.lit(1)).alias("times"))
        best = met.groupBy("class").agg(F.max_by("hub", F.struct("times", -F.col("hub"))).alias("hub"))
        return written(best.select(F.col("class").alias("a"), F.col("hub").alias("b")), "likely")

    def components(self, links: DataFrame) -> DataFrame:
        """Every class with its component."""
        found = connected(links, "a", "b").withColumnRenamed("node", "class")
        out = self.classes.select("class", "n").join(found, "class", "left")
        return written(out.select("class", "n", F.coalesce("component", "class").alias("component")), "components")

    def entries(self, labelled: DataFrame) -> DataFrame:
        """(token, class, component, n) for the rare shingles that classes of different components hold."""
        texts = self._texts(labelled.select("class", "component", "n"), "class", self.n_classes)
        sent = {"width": self.width, "buckets": self.buckets, "tokens": self.tokens, "counts": self.counts}
        shared = texts.mapInArrow(partial(_shared_batches, **sent), "part int, data binary")
        buckets, bits = self.buckets, self.bits

        def group_bits(group: pa.Table) -> pa.Table:
            return _filter_bits(group, buckets, bits)

        kept = {r["part"]: bytes(r["data"]) for r in shared.groupBy("part").applyInArrow(group_bits, "part int, data binary").collect()}
        run = partial(_entry_batches, **sent, bits=bits, kept=kept)
        return written(texts.mapInArrow(run, "token long, class long, component long, n long"), "entries")

    def lists(self, entries: DataFrame) -> DataFrame:
        """(token, held): one shingle for each distinct list of classes that spans components; equal lists give equal pairs."""
        size = F.count(F.lit(1)).alias("held")
        low, high = F.min("component").alias("low"), F.max("component").alias("high")
        mark, more = F.bit_xor(F.xxhash64("class")).alias("mark"), F.sum(F.shiftrightunsigned(F.xxhash64("class", F.lit(7)), 32)).alias("more")
        lists = entries.groupBy("token").agg(size, low, high, mark, more).where("low < high")
        return lists.groupBy("held", "low", "high", "mark", "more").agg(F.min("token").alias("token")).select("token", "held")

    def short_pairs(self, entries: DataFrame, lists: DataFrame) -> DataFrame:
        """Pairs of different components and fitting size from the lists of at most ``SHORT`` classes."""
        rows = entries.join(lists.where(F.col("held") <= SHORT).select("token"), "token")
        held = rows.groupBy("token").agg(F.collect_set(F.struct("class", "component", "n")).alias("held"))

        def fits(x: Column, y: Column) -> Column:
            sizes = F.least(x["n"], y["n"]) * 100 >= F.greatest(x["n"], y["n"]) * PERCENT
            return (x["class"] > y["class"]) & (x["component"] != y["component"]) & sizes

        def partners(x: Column) -> Column:
            return F.transform(
                F.filter("held", lambda y: fits(x, y)),
                lambda y: F.struct(x["class"].alias("a"), y["class"].alias("b"), (x["n"] + y["n"]).alias("both")),
            )

        return held.select(F.explode(F.flatten(F.transform("held", partners))).alias("pair")).select("pair.*").distinct()

    def bitmaps(self, classes: DataFrame) -> DataFrame:
        texts = self._texts(classes.distinct(), "class", self.n_classes)
        found = texts.mapInArrow(partial(_bitmap_batches, width=self.width), "class long, n long, bits binary")
        return written(found.dropDuplicates(["class"]), "bitmaps")

    def near(self, pairs: DataFrame, bitmaps: DataFrame) -> DataFrame:
        """Those of the pairs (a, b, both) that pass the bitmaps."""
        left = bitmaps.select(F.col("class").alias("a"), F.col("bits").alias("left"))
        right = bitmaps.select(F.col("class").alias("b"), F.col("bits").alias("right"))
        joined = pairs.join(left, "a").join(right, "b").select("a", "b", "both", "left", "right")
        return joined.mapInArrow(_near_batches, "a long, b long")

    def tiles(self, rows: DataFrame, bitmaps: DataFrame, best: bool) -> DataFrame:
        """Pairs of classes of different components that pass the bitmaps, from (token, held, class, component, n)."""
        band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / PERCENT)) + 1e-9).cast("int")
        live = rows.withColumns({"band": band, "blocks": F.ceil(F.col("held") / BLOCK).cast("int")})
        live = live.withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
        all_blocks = F.sequence(F.lit(0), F.col("blocks") - 1)

        def role(side: int, down: int) -> Column:
            def place(other: Column) -> Column:
                i, j = (other, F.col("block")) if side else (F.col("block"), other)
                return F.struct(F.lit(side).alias("side"), (F.col("band") - down).alias("at"), i.alias("i"), j.alias("j"))

            return F.transform(all_blocks, place)

        roles = F.concat(role(0, 0), role(1, 0), role(1, 1))  # left in the own band; right for the own band and the one below
        dealt = live.select("token", "class", "component", "n", "band", F.explode(roles).alias("t"))
        dealt = dealt.select(F.xxhash64("token", "t.at", "t.i", "t.j").alias("tile"), "t.side", "class", "component", "n", "band")
        useful = dealt.groupBy("tile").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min("side").alias("s0"), F.max("side").alias("s1"))
        dealt = dealt.join(useful.where("low < high AND s0 < s1").select("tile"), "tile", "left_semi").join(bitmaps.select("class", "bits"), "class")
        dealt = dealt.select("tile", "side", "class", "component", "n", "band", "bits")
        sorted_ = dealt.repartition("tile").sortWithinPartitions("tile")
        return sorted_.mapInArrow(partial(_tile_batches, best=best), "a long, b long")

    def run(self) -> DataFrame:
        """doc_id, n_shingles and component_id of every document."""
        links = self.confirm(self.likely())
        labelled = self.components(links)
        entries = self.entries(labelled)
        lists = written(self.lists(entries), "lists")
        pairs = written(self.short_pairs(entries, lists), "pairs")
        large = entries.join(lists.where(F.col("held") > SHORT), "token").select("token", "held", "class", "component", "n")
        held = large = written(large.distinct(), "large")
        discard(entries, lists)
        met = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class")))
        bitmaps = self.bitmaps(met.unionByName(large.select("class")))
        for best in (True, False):
            found = self.tiles(large, bitmaps, best)
            found = self.near(pairs, bitmaps).unionByName(found) if best else found
            near = written(found.distinct(), "near")
            more = self.confirm(near)
            discard(near)
            if not more.isEmpty():
                links = links.unionByName(more)
                labelled = self.components(links)
                large = large.drop("component").join(labelled.select("class", "component"), "class")
        discard(held, pairs, bitmaps)
        named = self.classes.join(labelled.select("class", "component"), "class").select("h1", "h2", "n", "component")
        out = self.rows.join(named, ["h1", "h2", "n"], "left")
        own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
        return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def near_duplicates(docs: DataFrame, text: str = "text", width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles and component_id of every row: the smallest doc_id that links reach.

    Takes doc_id, which names one text, and ``text``. Texts without words (null, empty, blank) have no shingles and link with
    nothing. Rows without doc_id are counted and link with nothing; their component is null. Repeated rows come out as often as
    they stand there. Other columns are ignored; an empty table gives an empty result.
    """
    return JaccardJoin(docs, text, width).run()
