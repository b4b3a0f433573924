"""Benchmark decontamination: size-partitioned MinHash containment search with exact verification.

A short item inside a long document has a small Jaccard similarity with it, so the search rates containment: how much of the
item's shingles the document holds. Items are partitioned by the size of their shingle set, in powers of two; an item's sketch
are the shingles of smallest hash, as many as its partition asks for. A document that holds the wanted share of an item lacks few
of its shingles, hence holds a known number of the sketch whatever its own length, and no such document is missed. What the
sketches let through is verified by exact counts. Items are a stated query set: they are sent out in blocks of bounded
size, one pass over the documents each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamarack.llm.common import list_column, shingle_hashes, shingle_sets, signed, tidied, word_hashes, written

#: Words in a shingle, least share of an item's shingles, and shingles of items that are sent to the executors at once.
WIDTH, SHARE, BLOCK_SHINGLES = 5, 0.75, 2_000_000

LEAK = T.StructType(
    [T.StructField("item_id", T.LongType()), T.StructField("item_shingles", T.IntegerType()), T.StructField("shared", T.IntegerType())]
)


@tidied
def _item_batches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        lengths = [n for *_, counts in word_hashes(texts) for n in counts.tolist()]
        for row, values, sizes in shingle_sets(texts, width):
            part = slice(row, row + len(sizes))
            yield pa.RecordBatch.from_arrays(
                [ids[part], pa.array(np.minimum(lengths[part], width).astype(np.int32)), list_column(signed(values), sizes)],
                ["item_id", "words", "shingles"],
            )


def needed(size: int, share: float) -> int:
    """Fewest shingles of a set that make up the share."""
    return max(1, math.ceil(round(size * share, 9)))


class Sketches:
    """The sketches of a block of items: sorted shingles, the items of each, and how many of a sketch a document must hold."""

    def __init__(self, items: list[tuple[int, int, np.ndarray]], share: float):
        self.items, self.least = items, np.zeros(len(items), np.int64)
        self.full = np.array([needed(len(s), share) for *_, s in items], np.int64)
        self.widths = sorted({w for _, w, _ in items})
        keys, owners = [], []
        for n, (_, _, shingles) in enumerate(items):
            upper = 2 ** len(shingles).bit_length() - 1  # largest set of the partition
            lacking = len(shingles) - int(self.full[n])
            size = min(len(shingles), 2 * (upper - needed(upper, share)) + 1)
            keys.append(shingles[:size])  # they are sorted by hash
            owners.append(np.full(size, n))
            self.least[n] = max(1, size - lacking)
        keys, owners = np.concatenate(keys), np.concatenate(owners)
        order = np.argsort(keys, kind="stable")
        self.owners = owners[order]
        self.keys, self.first, self.number = np.unique(keys[order], return_index=True, return_counts=True)
        self.rare = np.zeros(2**16, bool)
        self.rare[(self.keys >> np.uint64(48)).astype(np.int64)] = True

    def leaks(self, values: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(row, item, shared shingles) of the rows whose sorted sets lie in ``values`` one after the other."""
        at = np.flatnonzero(self.rare[(values >> np.uint64(48)).astype(np.int64)])
        spot = np.searchsorted(self.keys, values[at])
        same = self.keys[np.minimum(spot, len(self.keys) - 1)] == values[at]
        at, spot = at[same], spot[same]
        borders = np.concatenate([[0], np.cumsum(sizes)])
        row = np.searchsorted(borders, at, "right") - 1
        number = self.number[spot]
        within = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
        item = self.owners[np.repeat(self.first[spot], number) + within]
        pair, hits = np.unique(np.repeat(row, number) * len(self.items) + item, return_counts=True)
        row, item = pair // len(self.items), pair % len(self.items)
        for r, n in zip(row[hits >= self.least[item]].tolist(), item[hits >= self.least[item]].tolist()):
            mine, wanted = values[borders[r] : borders[r + 1]], self.items[n][2]
            found = np.minimum(np.searchsorted(mine, wanted), len(mine) - 1)
            shared = int((mine[found] == wanted).sum())
            if shared >= self.full[n]:
                yield r, n, shared


@tidied
def _mark_batches(
    batches: Iterator[pa.RecordBatch], items: list, share: float, width: int, column: str, keep: list[str]
) -> Iterator[pa.RecordBatch]:
    sketches = Sketches([(i, w, np.frombuffer(s, np.uint64)) for i, w, s in items], share) if items else None
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("item_shingles", pa.int32()), ("shared", pa.int32())]))
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        found: list[list[dict]] = [[] for _ in range(len(batch))]
        for begin, _, hashes, counts in word_hashes(texts) if sketches else ():
            for w in sketches.widths:  # items shorter than a shingle are looked for as runs of their own length
                values, number = shingle_hashes(hashes, counts, w)
                owner = np.repeat(np.arange(len(number)), number)
                order = np.lexsort((values, owner))
                values, owner = values[order], owner[order]
                fresh = np.ones(len(values), bool)
                fresh[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
                sizes = np.bincount(owner[fresh], minlength=len(number))
                for r, n, shared in sketches.leaks(values[fresh], sizes):
                    item, words, shingles = sketches.items[n]
                    if words == w:
                        found[begin + r].append({"item_id": item, "item_shingles": len(shingles), "shared": shared})
        columns = [batch.column(batch.schema.get_field_index(c)) for c in keep]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(found, kind)], [*keep, "_found"])


def mark_leaks(
    docs: DataFrame, items: DataFrame, share: float = SHARE, width: int = WIDTH, text: str = "text", block_shingles: int = BLOCK_SHINGLES
) -> DataFrame:
    """Add ``leaks`` to every row of ``docs``: an array of (item_id, item_shingles, shared), in order of item_id.

    A document leaks an item when it holds ``share`` or more of the item's distinct shingles. An item of fewer words than a
    shingle is one run of words, which the document holds or not. Null and empty texts hold nothing, and items without words or
    item_id are in no document; repeated items are counted once per item_id and text. An existing ``leaks`` is replaced; an
    empty table on either side gives empty results.
    """
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id IS NOT NULL").distinct()
    asked = asked.mapInArrow(partial(_item_batches, width=width), "item_id long, words int, shingles array<long>")
    asked = written(asked.where(F.size("shingles") > 0), "items")
    total = asked.agg(F.coalesce(F.sum(F.size("shingles")), F.lit(0))).first()[0]
    blocks = max(1, -(-int(total) // block_shingles))
    keep = [c for c in docs.columns if c not in ("leaks", "_found")]
    kept = docs.select(*keep)
    if blocks > 1:
        return _marked_by_text(kept, asked, blocks, share, width, text)
    run = partial(_mark_batches, items=_sent(asked, 1, 0), share=share, width=width, column=text, keep=keep)
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("_found", T.ArrayType(LEAK))])
    return kept.mapInArrow(run, schema).select(*keep, F.array_sort("_found").alias("leaks"))


def _sent(asked: DataFrame, blocks: int, block: int) -> list[tuple[int, int, bytes]]:
    """One block of items, of at most about the stated number of shingles."""
    rows = asked.where(F.pmod(F.xxhash64("item_id", "shingles"), F.lit(blocks)) == block).collect()
    return [(r["item_id"], r["words"], np.array(r["shingles"], np.int64).view(np.uint64).tobytes()) for r in rows]


def _marked_by_text(docs: DataFrame, asked: DataFrame, blocks: int, share: float, width: int, text: str) -> DataFrame:
    """Leaks of each block written before the next block is collected, then joined to the rows by a digest of the text.

    The driver and a task hold one block at a time; what is written are the leaking texts' digests and finds only. Rows of equal
    texts have equal leaks, so a digest's finds are at most the items that one text holds.
    """
    schema = T.StructType([T.StructField("_digest", T.BinaryType()), T.StructField("_found", T.ArrayType(LEAK))])
    digest = F.unhex(F.sha2(F.col(text), 256))
    asking = docs.select(digest.alias("_digest"), F.col(text).alias("_text")).where(F.col("_text").isNotNull())
    finds = []
    for block in range(blocks):
        run = partial(_mark_batches, items=_sent(asked, blocks, block), share=share, width=width, column="_text", keep=["_digest"])
        finds.append(written(asking.mapInArrow(run, schema).where(F.size("_found") > 0), "leaks"))
    found = reduce(DataFrame.unionAll, finds).select("_digest", F.explode("_found").alias("_leak")).distinct()
    leaks = found.groupBy("_digest").agg(F.array_sort(F.collect_list("_leak")).alias("leaks"))
    marked = docs.withColumn("_digest", digest).join(leaks, "_digest", "left")
    return marked.select(*docs.columns, F.coalesce("leaks", F.array().cast(T.ArrayType(LEAK))).alias("leaks"))
