"""Collocations: frequent phrases that a full-text index per shard counts exactly.

1. Tasks cut their texts into shards of one language and a bounded number of words, with a vocabulary of their own. The summed counts
   of words show which are frequent; all others end a phrase, like punctuation does.
2. Each shard gets an FM-index of its word ids and one of the reversed ids: Burrows-Wheeler transforms of suffixes sorted as deep as
   the phrases that are extended. A phrase is an interval in both. Extending it by a word on the right is a step in the
   reversed index, on the left one in the other; the step gives every extension at once, with its count, and keeps both intervals.
3. Phrases grow by one word a round, on the right and on the left in turn. A shard extends what is frequent in the whole collection,
   and only to phrases that are frequent without their far word too. Counts are summed over shards; a frequent phrase goes back to the
   shards that hold it, with their own intervals, so that no list of all phrases is needed anywhere.
   Pairs of words, by far the most, are first counted in hashed counters, which are dealt out in ranges and answered with one bit per
   counter that a shard has used: a pair whose counter stays below the bar cannot be frequent and is not sent.
4. Frequent phrases know the counts of all their beginnings and ends; the cut of least score is the phrase's score.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tamarack.llm.common import discard, mix, new_path, tidy, written
from tamarack.session import shuffle_width

#: Words of a shard, and bytes of text that are split at once.
SHARD_WORDS, SPLIT_BYTES = 2**20, 2**20

#: Words for each counter of pairs; counters of a range at least, and ranges at most (so many rows a shard sends).
WORDS_A_COUNTER, RANGE_COUNTERS, RANGES = 8, 2**16, 4096

#: Ends of a piece, in bytes; they become one byte that no UTF-8 text holds.
ENDS, BREAK = b".,;:!?\x0a\x0b\x0c\x0d", b"\xff"

_FOLD = bytes.maketrans(
    bytes(range(65, 91)) + b"\t" + ENDS, bytes(range(97, 123)) + b" " + BREAK * len(ENDS)
)


class Vocabulary(dict):
    """Ids of words in order of appearance; 0 is the end of a piece."""

    def __init__(self) -> None:
        super().__init__({BREAK: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def split_ids(texts: list[bytes], vocabulary: Vocabulary) -> Iterator[np.ndarray]:
    """Ids of the words of texts and ends of pieces, some at a time."""
    data = BREAK.join(texts).translate(_FOLD).replace(BREAK, b" " + BREAK + b" ")
    at = 0
    while at < len(data):
        end = at + SPLIT_BYTES
        if end < len(data):
            end = data.rfind(b" ", at, end) if b" " in data[at:end] else data.find(b" ", end)
            end = len(data) if end < 0 else max(end, at + 1)
        words = data[at:end].split()
        yield np.fromiter(map(vocabulary.__getitem__, words), np.int32, len(words))
        at = end
    yield np.zeros(1, np.int32)


def pack(values: np.ndarray) -> bytes:
    return pa.compress(values.tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes, n: int, kind: type = np.int32) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, n * np.dtype(kind).itemsize, codec="zstd", asbytes=True), kind)


_SHARDS = "shard long, lang string, n_words long, length int, ids binary, words array<string>, counts array<long>"


def _shards(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Shards of one language each, of about ``most`` words."""
    tidy()
    open_: dict[str, tuple[Vocabulary, list[np.ndarray]]] = {}
    sizes: dict[str, int] = {}
    made = 0

    def close(lang: str) -> pa.RecordBatch:
        nonlocal made
        vocabulary, parts = open_.pop(lang)
        sizes.pop(lang)
        ids = np.concatenate(parts)
        counts = np.bincount(ids, minlength=len(vocabulary))[1:]
        words = pa.array(list(vocabulary)[1:], pa.binary()).cast(pa.string())
        made += 1
        number = (TaskContext.get().partitionId() << 24) + made
        columns = [
            pa.array([number]), pa.array([lang]), pa.array([int(counts.sum())]), pa.array([len(ids)], pa.int32()),
            pa.array([pack(ids)], pa.binary()), pa.ListArray.from_arrays([0, len(words)], words),
            pa.ListArray.from_arrays([0, len(counts)], pa.array(counts.astype(np.int64))),
        ]
        return pa.RecordBatch.from_arrays(columns, ["shard", "lang", "n_words", "length", "ids", "words", "counts"])

    for batch in batches:
        langs = batch.column("lang").to_pylist()
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        by_lang: dict[str, list[bytes]] = {}
        for lang, text in zip(langs, texts):
            if text:
                by_lang.setdefault(lang, []).append(text)
        for lang, some in by_lang.items():
            if lang not in open_:
                open_[lang], sizes[lang] = (Vocabulary(), []), 0
            pieces = split_ids(some, open_[lang][0])
            for ids in pieces:
                open_[lang][1].append(ids)
                sizes[lang] += len(ids)
            if sizes[lang] >= most:
                yield close(lang)
            while sum(sizes.values()) >= 2 * most or len(sizes) > 64:
                yield close(max(sizes, key=sizes.get))
    for lang in list(open_):
        yield close(lang)


def transform(symbols: np.ndarray, depth: int) -> np.ndarray:
    """The Burrows-Wheeler transform with suffixes sorted by their first ``depth`` symbols; ``symbols`` end with 0."""
    bits = max(1, int(symbols.max(initial=0)).bit_length())
    ahead = np.concatenate([symbols, np.zeros(depth, symbols.dtype)]).astype(np.int64)
    n, per = len(symbols), max(1, 62 // bits)
    columns = []
    for begin in range(0, depth, per):
        key = np.zeros(n, np.int64)
        for k in range(begin, min(depth, begin + per)):
            key = (key << bits) | ahead[k : k + n]
        columns.append(key)
    order = np.lexsort(columns[::-1]) if len(columns) > 1 else np.argsort(columns[0], kind="stable")
    return symbols[order - 1]


_INDEX = "shard long, length int, words array<long>, forward binary, backward binary"


def _indexes(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[pa.RecordBatch]:
    """Transforms of each shard's frequent words and of the same reversed; words[k - 1] is the number of symbol k."""
    tidy()
    for batch in batches:
        for row in batch.to_pylist():
            numbers = np.array(row["numbers"], np.int64)
            places = np.argsort(numbers)
            symbol = np.zeros(max(row["places"]) + 1, np.int32)
            symbol[np.array(row["places"])[places]] = np.arange(1, len(places) + 1)
            ids = unpack(row["ids"], row["length"])
            text = np.where(ids < len(symbol), symbol[np.minimum(ids, len(symbol) - 1)], 0).astype(np.int32)
            text = text[(text != 0) | np.r_[False, text[:-1] != 0]]  # one end in a row
            text = np.r_[text, np.zeros(1, np.int32)]
            columns = [
                pa.array([row["shard"]]), pa.array([len(text)], pa.int32()), pa.array([numbers[places]], pa.list_(pa.int64())),
                pa.array([pack(transform(text, depth))], pa.binary()),
                pa.array([pack(transform(np.ascontiguousarray(np.r_[text[:-1][::-1], text[-1:]]), depth))], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "length", "words", "forward", "backward"])


def extend(
    bwt: np.ndarray, low: np.ndarray, other: np.ndarray, count: np.ndarray, n_symbols: int, prune: bool
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All extensions by one symbol of the phrases at intervals [low, low + count): phrase, symbol, low, other, count.

    ``low`` ascends and its intervals don't overlap; ``other`` are the same phrases' starts in the other index. With ``prune`` only
    extensions stay that lie in one of the given intervals, as those do which are given phrases without their far symbol.
    """
    starts = np.bincount(bwt, minlength=n_symbols + 2).cumsum()
    first = np.cumsum(count) - count
    phrase = np.repeat(np.arange(len(low)), count)
    place = np.arange(len(phrase)) + np.repeat(low - first, count)
    symbol = bwt[place]
    order = np.argsort(phrase * np.int64(n_symbols + 1) + symbol, kind="stable")
    phrase, symbol, place = phrase[order], symbol[order], place[order]
    head = np.flatnonzero(np.r_[True, (np.diff(phrase) != 0) | (np.diff(symbol) != 0)][: len(order)])
    counts = np.diff(np.r_[head, len(order)])
    phrase, symbol, place = phrase[head], symbol[head], place[head]
    new_other = other[phrase] + head - first[phrase]  # smaller symbols come first there
    small = bwt.astype(np.uint16) if n_symbols < 2**16 else bwt  # 16 bits sort fastest
    rank = np.empty(len(bwt), np.int64)
    rank[np.argsort(small, kind="stable")] = np.arange(len(bwt))
    keep = symbol != 0
    phrase, symbol, place, counts, new_other = (a[keep] for a in (phrase, symbol, place, counts, new_other))
    new_low = rank[place]  # the symbol's block, and within it as many as stand before
    assert not len(new_low) or (new_low >= starts[symbol - 1]).all()
    if prune and len(low):
        at = np.searchsorted(low, new_low, "right") - 1
        keep = (at >= 0) & (new_low < low[at] + count[at])
        phrase, symbol, new_low, new_other, counts = (a[keep] for a in (phrase, symbol, new_low, new_other, counts))
    return phrase, symbol, new_low, new_other, counts


def _opening(row: dict, words: np.ndarray, here: str) -> tuple[np.ndarray, ...]:
    """All pairs of a shard's frequent words: first word, second word, low, other, count."""
    bwt = unpack(row[here].as_py(), row["length"].as_py())
    size = np.bincount(bwt, minlength=len(words) + 1)
    low = np.cumsum(size)[:-1]
    phrase, symbol, *rest = extend(bwt, low, low, size[1:], len(words), False)
    return words[phrase], words[symbol - 1], *rest


def counter_of(base: np.ndarray, word: np.ndarray, counters: int) -> np.ndarray:
    """The counter of each pair; ``counters`` is a power of two."""
    return (mix(mix(base.astype(np.uint64)) + word.astype(np.uint64)) & np.uint64(counters - 1)).astype(np.int64)


_NOTED = "range long, shard long, n int, places binary, counts binary"


def _noted(batches: Iterator[pa.RecordBatch], counters: int, width: int, least: int) -> Iterator[pa.RecordBatch]:
    """What each shard adds to the counters of pairs, by range of ``width`` counters; ``least`` and more count alike."""
    tidy()
    for batch in batches:
        for k in range(len(batch)):
            row = {c: batch.column(c)[k] for c in batch.schema.names}
            base, word, _, _, count = _opening(row, row["words"].values.to_numpy(), "backward")
            used, at = np.unique(counter_of(base, word, counters), return_inverse=True)
            total = np.minimum(np.bincount(at, count, len(used)), least).astype(np.int32)
            ranges, first = np.unique(used // width, return_index=True)
            parts = list(zip(ranges.tolist(), np.split(used % width, first[1:]), np.split(total, first[1:])))
            columns = [
                pa.array(ranges), pa.array([row["shard"].as_py()] * len(parts), pa.int64()), pa.array([len(p) for _, p, _ in parts], pa.int32()),
                pa.array([pack(np.diff(p, prepend=0).astype(np.int32)) for _, p, _ in parts], pa.binary()),
                pa.array([pack(t) for _, _, t in parts], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["range", "shard", "n", "places", "counts"])


def _answered(table: pa.Table, width: int, least: int) -> pa.Table:
    """For each shard of a range, which of its counters reach ``least`` in all shards together."""
    total = np.zeros(width, np.int64)
    rows = list(zip(*(table[c].to_pylist() for c in ("n", "places", "counts"))))
    for n, places, counts in rows:
        total[np.cumsum(unpack(places, n))] += unpack(counts, n)
    enough = total >= least
    bits = [np.packbits(enough[np.cumsum(unpack(places, n))]).tobytes() for n, places, _ in rows]
    return pa.table({"shard": table["shard"], "range": table["range"], "bits": pa.array(bits, pa.binary())})


def _possible(row: dict, base: np.ndarray, word: np.ndarray, counters: int, width: int) -> np.ndarray:
    """Which pairs of a shard have a counter that is high enough."""
    used, at = np.unique(counter_of(base, word, counters), return_inverse=True)
    ranges, first = np.unique(used // width, return_index=True)
    answers = {a["range"]: a["bits"] for a in row["answers"].as_py()}
    parts = [np.unpackbits(np.frombuffer(answers[r], np.uint8))[: len(p)] for r, p in zip(ranges.tolist(), np.split(used, first[1:]))]
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint8)).astype(bool)[at]


_FOUND = "shard long, base long, word long, count int, forward_low int, backward_low int"


def _extensions(batches: Iterator[pa.RecordBatch], right: bool, opening: tuple[int, int] | None) -> Iterator[pa.RecordBatch]:
    """Extensions of a shard's frequent phrases on one side; at first pairs of words, where their counter allows."""
    here, there = ("backward", "forward") if right else ("forward", "backward")
    tidy()
    for batch in batches:
        for k in range(len(batch)):
            row = {c: batch.column(c)[k] for c in batch.schema.names}
            words = row["words"].values.to_numpy()
            if opening:
                found = _opening(row, words, here)
                found = [a[_possible(row, *found[:2], *opening)] for a in found]
            else:
                phrases = row["phrases"].values
                base, count, low, other = (phrases.field(c).to_numpy().astype(np.int64) for c in ("number", "count", f"{here}_low", f"{there}_low"))
                order = np.argsort(low)
                bwt = unpack(row[here].as_py(), row["length"].as_py())
                phrase, symbol, *rest = extend(bwt, low[order], other[order], count[order], len(words), True)
                found = [base[order][phrase], words[symbol - 1], *rest]
            base, word, low, other, count = found
            lows = {here: low, there: other}
            for at in range(0, len(base), 2**17):
                part = slice(at, at + 2**17)
                columns = [
                    np.full(len(base[part]), row["shard"].as_py(), np.int64), base[part], word[part], count[part].astype(np.int32),
                    lows["forward"][part].astype(np.int32), lows["backward"][part].astype(np.int32),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["shard", "base", "word", "count", "forward_low", "backward_low"])


def _bucketed(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder, bucketed by shard: what is joined to it by shard moves, the table itself never does."""
    spark = df.sparkSession
    path, table = new_path(spark, name), f"tamarack_{name}_{uuid.uuid4().hex}"
    df.write.option("path", path).bucketBy(shuffle_width(spark), "shard").saveAsTable(table)
    out = spark.table(table)
    out.written_to, out.table_name = path, table
    return out


def _counted(own: DataFrame, *key: str, least: int) -> DataFrame:
    """Rows of shards whose ``key`` occurs ``least`` times in all shards together, with that sum as f and a number of the key.

    A key has one row per shard that holds it; the row whose ``own`` number is the key's stands for the key.
    """
    own = own.withColumn("own", F.monotonically_increasing_id())
    everywhere = W.partitionBy(*key)
    count = F.sum(F.col("count").cast("long")).over(everywhere)
    return written(own.select("*", count.alias("f"), F.min("own").over(everywhere).alias("number")).where(F.col("f") >= least), "held")


def _drop(df: DataFrame) -> None:
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {df.table_name}")
    discard(df)


def _with(values: str, value: str) -> Column:
    return F.concat(values, F.array(value))


def _described(found: DataFrame, shorter: DataFrame, words: DataFrame, right: bool, size: int) -> DataFrame:
    """Frequent phrases of ``size`` words with text, numbers of beginning and end, and counts of all beginnings and ends."""
    names = words.select(F.col("number").alias("word"), F.col("phrase").alias("text"))
    base = shorter.select([F.col(c).alias(f"b_{c}") for c in shorter.columns])
    side = shorter.select([F.col(c).alias(f"s_{c}") for c in shorter.columns])
    out = found.join(names, "word").join(base, F.col("base") == F.col("b_number"))
    if size == 2:
        out = out.join(side, F.col("word") == F.col("s_number"))
    elif right:  # the end of the new phrase: the end of its base and the new word
        out = out.join(side, (F.col("s_beginning") == F.col("b_end")) & (F.col("s_last") == F.col("word")))
    else:
        out = out.join(side, (F.col("s_end") == F.col("b_beginning")) & (F.col("s_first") == F.col("word")))
    beginning, end = ("b", "s") if right else ("s", "b")
    text = F.concat_ws(" ", "b_phrase", "text") if right else F.concat_ws(" ", "text", "b_phrase")
    return out.select(
        "number", F.col("b_lang").alias("lang"), text.alias("phrase"), "f", F.col(f"{beginning}_number").alias("beginning"),
        F.col(f"{end}_number").alias("end"), F.col(f"{beginning}_first").alias("first"), F.col(f"{end}_last").alias("last"),
        _with(f"{beginning}_beginnings", f"{beginning}_f").alias("beginnings"), _with(f"{end}_ends", f"{end}_f").alias("ends"),
    )


def _scored(phrases: DataFrame, sizes: DataFrame) -> DataFrame:
    """Each phrase's cut of least score, the first of equal ones."""
    wide = lambda c: F.col(c).cast("decimal(19,0)")  # noqa: E731  products have up to 38 digits
    cuts = phrases.join(F.broadcast(sizes), "lang").select("lang", "phrase", F.col("f").alias("a"), "n", "ends", F.posexplode("beginnings").alias("k", "l"))
    cuts = cuts.withColumn("r", F.element_at("ends", F.size("ends") - F.col("k")))
    cuts = cuts.withColumn("over", F.lit(1000).cast("decimal(19,0)") * (wide("a") * wide("n")).cast("decimal(35,0)")).withColumn("under", wide("l") * wide("r"))
    cuts = cuts.withColumn("score", F.expr("over div under"))
    least = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    return cuts.groupBy("lang", "phrase", "a", "n").agg(least).select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def collocations(docs: DataFrame, least: int = 100, most_words: int = 5, best: int | None = 2000) -> DataFrame:
    """lang, rank (from 1), phrase, a, l, r, n and score of each language's ``best`` phrases (None: all) of 2 to ``most_words`` words.

    Takes lang (null: ``und``) and text (null, empty or blank: no words). A phrase counts from ``least`` occurrences on and lies
    within a piece; it is left out if a longer one that holds it occurs as often. Repeated rows count each time. No frequent
    phrase gives no rows. All numbers are exact. Languages are as many as the data has; one row per language is broadcast.
    """
    schema = "lang string, rank int, phrase string, a long, l long, r long, n long, score long"
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text"))
    most = SHARD_WORDS
    shards = _bucketed(texts.mapInArrow(lambda b: _shards(b, most), _SHARDS), "shards")
    sizes = written(shards.groupBy("lang").agg(F.sum("n_words").alias("n")), "sizes")
    own = shards.select("shard", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "entry"))
    own = own.select("shard", "lang", (F.col("place") + 1).alias("place"), F.col("entry.words").alias("phrase"), F.col("entry.counts").alias("count"))
    held = _counted(own, "lang", "phrase", least=least)
    words = written(held.where("own = number").select("number", "lang", "phrase", "f"), "words")
    none = F.array().cast("array<long>")
    unknown = F.lit(None).cast("long")
    shorter = words.select("*", unknown.alias("beginning"), unknown.alias("end"), F.col("number").alias("first"), F.col("number").alias("last"), none.alias("beginnings"), none.alias("ends"))
    by_shard = held.groupBy("shard").agg(F.collect_list("place").alias("places"), F.collect_list("number").alias("numbers"))
    depth = max(1, most_words - 1)
    source = shards.select("shard", "length", "ids").join(by_shard, "shard")
    indexes = _bucketed(source.mapInArrow(lambda b: _indexes(b, depth), _INDEX), "index")
    _drop(shards)
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    counters = 1 << max(16, (total // WORDS_A_COUNTER).bit_length())
    width = max(RANGE_COUNTERS, counters // RANGES)
    noted = indexes.select("shard", "length", "words", "backward").mapInArrow(lambda b: _noted(b, counters, width, least), _NOTED)
    answered = noted.groupBy("range").applyInArrow(lambda t: _answered(t, width, least), "shard long, range long, bits binary")
    state = answered.groupBy("shard").agg(F.collect_list(F.struct("range", "bits")).alias("answers"))
    phrases = []
    for size in range(2, most_words + 1):
        right, opening = size % 2 == 0, (counters, width) if size == 2 else None
        source = indexes.select("shard", "length", "words", "backward" if right else "forward").join(state, "shard")
        found = source.mapInArrow(lambda b, right=right, opening=opening: _extensions(b, right, opening), _FOUND)
        last, held = held, _counted(found, "base", "word", least=least)
        discard(last)
        frequent = written(held.where("own = number").select("number", "base", "word", "f"), "frequent")
        shorter = written(_described(frequent, shorter, words, right, size), "phrases")
        phrases.append(shorter)
        if not frequent.count():
            break
        entry = F.struct("number", "count", "forward_low", "backward_low")
        state = held.groupBy("shard").agg(F.collect_list(entry).alias("phrases"))
    discard(held)
    _drop(indexes)
    kept = []
    for k, some in enumerate(phrases):
        if k + 1 < len(phrases):
            longer = phrases[k + 1]
            around = longer.select(F.explode(F.array("beginning", "end")).alias("number"), F.col("f").alias("whole"))
            around = around.groupBy("number").agg(F.max("whole").alias("whole"))
            some = some.join(around, "number", "left").where("whole IS NULL OR whole < f")
        kept.append(some.select("lang", "phrase", "f", "beginnings", "ends"))
    if not kept:
        return spark.createDataFrame([], schema)
    out = kept[0]
    for more in kept[1:]:
        out = out.unionByName(more)
    place = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = _scored(out, sizes).withColumn("rank", F.row_number().over(place))
    if best is not None:
        ranked = ranked.where(F.col("rank") <= best)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
