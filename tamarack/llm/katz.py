"""Katz backoff language model of order two, learnt and evaluated on packed n-gram tables.

    P1(w)    = d1 c(w) / N, what the discounts free goes to the one unknown word
    P2(w|h)  = d2 c(h, w) / (c(h) + RESERVE)             if c(h, w) > 0
             = a(h) P1(w)                                else; a(h) makes the probabilities after h sum to one

with Good-Turing discounts d for counts up to five. ``RESERVE`` keeps a little for contexts all of whose counts are large. A text
begins after a mark that is a context only, and ends with a token of its own.

Tokens travel packed: a task sorts the words, contexts and documents of some million tokens and sends each share of the words to
its bucket as bytes. Buckets go by word (common words by word and context), so a bucket counts whole bigrams, knows P1 of their
words, and needs the discounts and a(h) only later: it adds up, per document, how many tokens have each small count, and per
context the sums that a(h) asks for. Words are told apart by 48 bits of their hash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.llm.common import discard, word_hashes, written

#: Counts up to this are discounted; counts reserved per context; tokens sorted at once; tokens per bucket; most rows of a chunk.
SMALL, RESERVE, CHUNK_TOKENS, BUCKET_TOKENS, CHUNK_ROWS = 5, 0.1, 1_500_000, 2_000_000, 32_768

#: Ids below this are short codes of the commonest words as contexts; it shortens what is sent, nothing else.
CODES = 65_536

#: Fewest buckets, and contexts' buckets.
LEAST_BUCKETS = 16

END, BEGIN, MASK = np.uint64(1), np.uint64(2), np.uint64(2**48 - 1)

_PART = "kind int, part int, chunk long, data binary"
_NAMES = ["kind", "part", "chunk", "data"]


def _pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *(len(a.tobytes()) for a in arrays)], np.int64).tobytes()
    return head + b"".join(a.tobytes() for a in arrays)


def _unpack(data: bytes, *kinds: str) -> list[np.ndarray]:
    n = int(np.frombuffer(data, np.int64, 1)[0])
    sizes = np.frombuffer(data, np.int64, n, 8).tolist()
    out, at = [], 8 * (n + 1)
    for size, kind in zip(sizes, kinds):
        part = np.frombuffer(data, np.uint8, size, at)
        out.append(_wide(part) if kind == "u6" else part.view(kind) if at % 8 == 0 else np.frombuffer(part.tobytes(), kind))
        at += size
    return out


def _narrow(ids: np.ndarray) -> np.ndarray:
    """48-bit ids as six bytes each."""
    return np.ascontiguousarray(ids).view(np.uint8).reshape(-1, 8)[:, :6].copy()


def _wide(raw: np.ndarray) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = raw.reshape(-1, 6)
    return out.view(np.uint64).ravel()


def _tokens(batches: Iterator[pa.RecordBatch], each: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Chunks of documents: ids and row numbers of all tokens in order (words, then the end), doc_id and flag of each row."""
    held: list[tuple] = []

    def chunk() -> tuple:
        rows = np.concatenate([h[1] for h in held])
        ids = np.concatenate([h[0] for h in held])
        counts = rows + 1
        ends = np.cumsum(counts) - 1
        tokens = np.empty(int(counts.sum()), np.uint64)
        inner = np.ones(len(tokens), bool)
        inner[ends] = False
        tokens[inner], tokens[ends] = ids, END
        out = tokens, np.repeat(np.arange(len(rows)), counts), np.concatenate([h[2] for h in held]), np.concatenate([h[3] for h in held])
        held.clear()
        return out

    waiting = rows = 0
    for batch in batches:
        doc_ids = batch.column(0)
        flags = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
        doc_ids = np.array(doc_ids.to_pylist(), object)
        for begin, end, hashes, counts in word_hashes(batch.column(1)):
            ids = hashes & MASK
            ids[ids < CODES] += np.uint64(CODES)
            held.append((ids, counts, doc_ids[begin:end], flags[begin:end]))
            waiting, rows = waiting + len(ids), rows + len(counts)
            if waiting >= each or rows >= CHUNK_ROWS // 2:
                yield chunk()
                waiting = rows = 0
    if held:
        yield chunk()


def _split_rows(chunk: tuple) -> Iterator[tuple]:
    """Chunks of at most CHUNK_ROWS documents."""
    tokens, row, ids, flags = chunk
    for first in range(0, len(ids), CHUNK_ROWS):
        a, b = np.searchsorted(row, [first, first + CHUNK_ROWS])
        yield tokens[a:b], row[a:b] - first, ids[first : first + CHUNK_ROWS], flags[first : first + CHUNK_ROWS]


def _word_batches(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Counts of the words of training documents, one row per bucket and chunk."""
    for tokens, row, _, flags in _tokens(batches, CHUNK_TOKENS):
        words, counts = np.unique(tokens[~flags[row]], return_counts=True)
        bucket = (words % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        words, counts = words[order], counts[order]
        edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
        used = [b for b in range(buckets) if edges[b] < edges[b + 1]]
        data = [_pack(_narrow(words[edges[b] : edges[b + 1]]), counts[edges[b] : edges[b + 1]].astype(np.uint32)) for b in used]
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(data, pa.binary())], ["part", "data"])


def _sum_by(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    unique, place = np.unique(keys, return_inverse=True)
    return unique, np.bincount(place, weights=values, minlength=len(unique))


def _add_words(group: pa.Table, most: int) -> pa.Table:
    parts = [_unpack(d.as_py(), "u6", "<u4") for d in group["data"]]
    words, counts = _sum_by(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
    counts = counts.astype(np.int64)
    top = np.argsort(-counts, kind="stable")[:most]
    singles = [int((counts == r).sum()) for r in range(1, SMALL + 2)]
    return pa.table(
        {
            "part": pa.array([group["part"][0].as_py()], pa.int32()),
            "data": pa.array([_pack(_narrow(words), counts)], pa.binary()),
            "total": pa.array([int(counts.sum())], pa.int64()),
            "types": pa.array([len(words)], pa.int64()),
            "with_count": pa.array([singles], pa.list_(pa.int64())),
            "top_words": pa.array([words[top].astype(np.int64).tolist()], pa.list_(pa.int64())),
            "top_counts": pa.array([counts[top].tolist()], pa.list_(pa.int64())),
        }
    )


def discounts(with_count: list[int]) -> np.ndarray:
    """Katz's discount of the counts 1..SMALL from the numbers of n-grams with counts 1..SMALL+1.

    Where Good-Turing gives no number in 0..1, all are by absolute discounting, which needs only counts of one and two.
    """
    n = [0, *with_count]
    if all(n[1:]):
        tail = (SMALL + 1) * n[SMALL + 1] / n[1]
        if tail < 1:
            d = [((r + 1) * n[r + 1] / n[r] / r - tail) / (1 - tail) for r in range(1, SMALL + 1)]
            if all(0 < x < 1 for x in d):
                return np.array(d)
    cut = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
    return np.array([(r - cut) / r for r in range(1, SMALL + 1)])


class WordModel:
    """P1 as a function of a word's count; the unknown word has count 0."""

    def __init__(self, total: int, types: int, with_count: list[int]):
        self.total, self.types, self.d = total, types, discounts(with_count)
        kept = total - sum((1 - self.d[r - 1]) * r * with_count[r - 1] for r in range(1, SMALL + 1))
        free = max(total - kept, 0.5)  # without small counts the unknown word still gets half a count
        self.scale = (1 - free / (total + 0.5)) / kept if kept > 0 else 0.0
        self.unknown = free / (total + 0.5) if kept > 0 else 1.0

    def p(self, counts: np.ndarray) -> np.ndarray:
        d = np.concatenate([[0.0], self.d, [1.0]])[np.minimum(counts, SMALL + 1)]
        return np.where(counts > 0, self.scale * d * counts, self.unknown)


def _is_common(words: np.ndarray, common: np.ndarray) -> np.ndarray:
    if not len(common):
        return np.zeros(len(words), bool)
    return common[np.minimum(np.searchsorted(common, words), len(common) - 1)] == words


def _coded(words: np.ndarray, coded: np.ndarray) -> np.ndarray:
    """Common words as codes from 16 to CODES - 1, the place in the sorted ``coded``; the others as they are."""
    if not len(coded):
        return words
    at = np.minimum(np.searchsorted(coded, words), len(coded) - 1)
    return np.where(coded[at] == words, (at + 16).astype(np.uint64), words)


def _pack_contexts(before: np.ndarray) -> list[np.ndarray]:
    short = before < CODES
    return [np.packbits(short), before[short].astype(np.uint16), _narrow(before[~short])]


def _unpack_contexts(n: int, flags: np.ndarray, short: np.ndarray, long: np.ndarray) -> np.ndarray:
    is_short = np.unpackbits(flags, count=n).astype(bool)
    out = np.empty(n, np.uint64)
    out[is_short], out[~is_short] = short, long
    return out


def _bigram_batches(batches: Iterator[pa.RecordBatch], buckets: int, common: np.ndarray, coded: np.ndarray) -> Iterator[pa.RecordBatch]:
    """All tokens with context and document, sorted, one row per bucket and chunk; and one row per chunk about its documents."""
    context = TaskContext.get()
    number = 0
    for whole in _tokens(batches, CHUNK_TOKENS):
        for tokens, row, doc_ids, held in _split_rows(whole):
            chunk = (context.partitionId() << 24) + number
            number += 1
            before = np.concatenate([[BEGIN], _coded(tokens[:-1], coded)])
            before[1:][row[1:] != row[:-1]] = BEGIN
            spread = np.where(_is_common(tokens, common), tokens ^ (before * np.uint64(0x9E3779B1)), tokens)
            bucket = (spread % np.uint64(buckets)).astype(np.uint32)
            order = np.lexsort((before, tokens, bucket))
            tokens, before, bucket = tokens[order], before[order], bucket[order]
            mark = (row[order] | np.where(held[row[order]], CHUNK_ROWS, 0)).astype(np.uint16)
            fresh = np.ones(len(tokens), bool)
            fresh[1:] = (tokens[1:] != tokens[:-1]) | (before[1:] != before[:-1])
            at = np.flatnonzero(fresh)
            times = np.diff(np.append(at, len(tokens)))
            new_word = np.ones(len(at), bool)
            new_word[1:] = tokens[at][1:] != tokens[at][:-1]
            edges = np.searchsorted(bucket, np.arange(buckets + 1))
            starts = np.searchsorted(at, edges)
            data, used = [], []
            for b in range(buckets):
                lo, hi = starts[b], starts[b + 1]
                if lo == hi:
                    continue
                first = new_word[lo:hi].copy()
                first[0] = True
                heads = np.flatnonzero(first)
                mine = at[lo:hi]
                data.append(
                    _pack(
                        _narrow(tokens[mine[heads]]),
                        np.diff(np.append(heads, hi - lo)).astype(np.uint32),
                        *_pack_contexts(before[mine]),
                        np.minimum(times[lo:hi], 255).astype(np.uint8),
                        times[lo:hi][times[lo:hi] >= 255].astype(np.uint32),
                        mark[edges[b] : edges[b + 1]],
                    )
                )
                used.append(b)
            n_tokens = np.bincount(row, minlength=len(doc_ids))
            none = np.array([d is None for d in doc_ids], np.uint8)
            ids = np.array([0 if d is None else d for d in doc_ids], np.int64)
            data.append(_pack(ids, none, held.astype(np.uint8), n_tokens.astype(np.int64)))
            kinds = [2] * len(used) + [3]
            parts = [*used, chunk % buckets]
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds, pa.int32()), pa.array(parts, pa.int32()), pa.array([chunk] * len(kinds), pa.int64()), pa.array(data, pa.binary())],
                _NAMES,
            )


def _rows(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary())
    return pa.table({n: pa.array([r[k] for r in rows], t) for k, (n, t) in enumerate(zip(_NAMES, kinds))})


def _count_bucket(group: pa.Table, model: WordModel, common: dict[int, int], context_buckets: int) -> pa.Table:
    """Kinds in: 0 words and counts, 2 tokens, 3 documents. Kinds out: 0 contexts, 1 unseen tokens, 2 sums, 3 documents, 4 counts."""
    out: list[tuple[int, int, int, bytes]] = []
    known_words = [np.array(sorted(common), np.uint64)]
    known_counts = [np.array([common[w] for w in sorted(common)], np.int64)]
    blocks = []
    for kind, chunk, data in zip(group["kind"].to_pylist(), group["chunk"].to_pylist(), group["data"]):
        if kind == 0:
            words, counts = _unpack(data.as_py(), "u6", "<i8")
            known_words.append(words)
            known_counts.append(counts)
        elif kind == 3:
            out.append((3, 0, chunk, data.as_py()))
        else:
            own, numbers, flags, short, long, times, more, mark = _unpack(data.as_py(), "u6", "<u4", "u1", "<u2", "u6", "u1", "<u4", "<u2")
            times = times.astype(np.int32)
            times[times == 255] = more
            blocks.append((chunk, own, numbers, _unpack_contexts(len(times), flags, short, long), times, mark))
    if not blocks:
        return _rows(out)
    known, place = np.unique(np.concatenate(known_words), return_index=True)
    counts = np.concatenate(known_counts)[place]
    words = np.unique(np.concatenate([b[1] for b in blocks]))
    at = np.minimum(np.searchsorted(known, words), max(0, len(known) - 1))
    single = np.where(known[at] == words, counts[at], 0) if len(known) else np.zeros(len(words), np.int64)  # count of each word
    p1 = model.p(single)
    del known, counts, known_words, known_counts, at, place
    word = np.concatenate([np.repeat(np.searchsorted(words, b[1]).astype(np.int32), b[2]) for b in blocks])
    before = np.concatenate([b[3] for b in blocks])
    times = np.concatenate([b[4] for b in blocks])
    trained = np.add.reduceat(np.concatenate([b[5] for b in blocks]) < CHUNK_ROWS, np.cumsum(times) - times, dtype=np.int32)
    del times
    order = np.lexsort((before, word))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (word[order[1:]] != word[order[:-1]]) | (before[order[1:]] != before[order[:-1]])
    group_of = np.empty(len(order), np.int32)
    group_of[order] = np.cumsum(fresh, dtype=np.int32) - 1
    total = np.bincount(group_of, weights=trained).astype(np.int64)

    first = order[fresh]
    seen = total > 0
    own_context, own_total, own_p1 = before[first[seen]], total[seen], p1[word[first[seen]]]
    del order, fresh, first, trained, before
    contexts, slot = np.unique(own_context, return_inverse=True)
    if len(contexts):
        sums = [np.bincount(slot, weights=own_total), np.bincount(slot, weights=own_p1)]
        small = [np.bincount(slot, weights=own_total == r).astype(np.uint32) for r in range(1, SMALL + 1)]
        share = (contexts % np.uint64(context_buckets)).astype(np.int64)
        by = np.argsort(share, kind="stable")
        edges = np.searchsorted(share[by], np.arange(context_buckets + 1))
        for b in range(context_buckets):
            pick = by[edges[b] : edges[b + 1]]
            if len(pick):
                out.append((0, b, 0, _pack(_narrow(contexts[pick]), sums[0][pick].astype(np.int64), sums[1][pick], *[s[pick] for s in small])))
    out.append((4, 0, 0, _pack(np.array([int((total == r).sum()) for r in range(1, SMALL + 2)], np.int64))))

    begin = 0
    end_at = int(np.searchsorted(words, END)) if END in words else -1
    for chunk, _, _, ctx, t, m in blocks:
        own, pair = word[begin : begin + len(ctx)], total[group_of[begin : begin + len(ctx)]]
        begin += len(ctx)
        row = (m & (CHUNK_ROWS - 1)).astype(np.int64)
        c1, c2 = np.repeat(single[own], t), np.repeat(pair, t)
        is_word = np.repeat(own != end_at, t)
        rows, place = np.unique(row, return_inverse=True)

        def per_row(values: np.ndarray) -> np.ndarray:
            return np.bincount(place, weights=values, minlength=len(rows))

        base = per_row(np.log10(c1 + 1.0))
        logs = np.where(c2 > SMALL, np.log10(np.maximum(c2, 1)), 0.0) + np.where(c2 == 0, np.log10(np.repeat(p1[own], t)), 0.0)
        logs -= np.where(is_word & (c1 > 0), np.log10(c1 + RESERVE), 0.0)
        classes = [per_row(c2 == r).astype(np.uint32) for r in range(1, SMALL + 1)]
        out.append((2, 0, chunk, _pack(rows.astype(np.uint16), base, per_row(logs), per_row(c1 > 0).astype(np.uint32), *classes)))
        lost = np.flatnonzero(c2 == 0)
        if len(lost):
            ctx_of = np.repeat(ctx, t)[lost]
            share = (ctx_of % np.uint64(context_buckets)).astype(np.int64)
            by = np.argsort(share, kind="stable")
            edges = np.searchsorted(share[by], np.arange(context_buckets + 1))
            for b in np.unique(share).tolist():
                pick = by[edges[b] : edges[b + 1]]
                out.append((1, b, chunk, _pack(_narrow(ctx_of[pick]), row[lost[pick]].astype(np.uint16))))
    return _rows(out)


def _contexts_of(parts: list[list[np.ndarray]]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Contexts of a bucket with the sums of their parts: count, P1 of the words seen after them, numbers of small counts."""
    keys, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return keys, [np.bincount(place, weights=np.concatenate([p[k] for p in parts]), minlength=len(keys)) for k in range(1, SMALL + 3)]


def backoff(counted: list[np.ndarray], d: np.ndarray) -> np.ndarray:
    """(c(h) + RESERVE) a(h) of contexts: what the discounts leave, over the P1 of what was not seen after them."""
    kept = counted[0] - sum((1 - d[r - 1]) * r * counted[1 + r] for r in range(1, SMALL + 1))
    return (counted[0] + RESERVE - kept) / np.maximum(1.0 - counted[1], 1e-12)


def _weigh_bucket(group: pa.Table, d: np.ndarray) -> pa.Table:
    """Kinds in: 0 contexts, 1 unseen tokens. Out: 5, per chunk the rows' sums of log10 of the backoff weights."""
    kinds, chunks, data = group["kind"].to_pylist(), group["chunk"].to_pylist(), group["data"]
    layout = ("u6", "<i8", "<f8", *["<u4"] * SMALL)
    parts = [_unpack(x.as_py(), *layout) for k, x in zip(kinds, data) if k == 0]
    keys, counted = _contexts_of(parts) if parts else (np.zeros(0, np.uint64), [])
    weight = np.log10(backoff(counted, d)) if parts else np.zeros(0)
    out = []
    for kind, chunk, x in zip(kinds, chunks, data):
        if kind == 1 and len(keys):
            ctx, row = _unpack(x.as_py(), "u6", "<u2")
            at = np.minimum(np.searchsorted(keys, ctx), len(keys) - 1)
            rows, sums = _sum_by(row, np.where(keys[at] == ctx, weight[at], 0.0))
            out.append((5, 0, chunk, _pack(rows.astype(np.uint16), sums)))
    return _rows(out)


def _finish_chunk(group: pa.Table, d: np.ndarray, total: int, types: int, docs: int) -> pa.Table:
    kinds, data = group["kind"].to_pylist(), group["data"]
    ids, none, held, n_tokens = _unpack(data[kinds.index(3)].as_py(), "<i8", "u1", "u1", "<i8")
    base, score, known = np.zeros(len(ids)), np.zeros(len(ids)), np.zeros(len(ids), np.int64)
    logs = np.log10(d * np.arange(1, SMALL + 1))
    for kind, x in sorted(zip(kinds, (v.as_py() for v in data))):  # in one order, so that sums do not depend on arrival
        if kind == 2:
            rows, b, s, k, *classes = _unpack(x, "<u2", "<f8", "<f8", "<u4", *["<u4"] * SMALL)
            base[rows] += b
            known[rows] += k
            score[rows] += s + sum(c * g for c, g in zip(classes, logs))
        elif kind == 5:
            rows, s = _unpack(x, "<u2", "<f8")
            score[rows] += s
    base -= n_tokens * math.log10(total + types + 1)
    if docs:
        score -= math.log10(docs + RESERVE)
    return pa.table(
        {
            "doc_id": pa.array(ids, pa.int64(), mask=none.astype(bool)),
            "held_out": pa.array(held.astype(bool)),
            "n_tokens": pa.array(n_tokens),
            "n_known": pa.array(known),
            "train_tokens": pa.array(np.full(len(ids), total, np.int64)),
            "base_score": pa.array(base),
            "score": pa.array(score),
        }
    )


def katz_scores(docs: DataFrame, held_out: str = "held_out", text: str = "text") -> DataFrame:
    """Learn from the rows that are not held out, and score all rows.

    Takes doc_id, ``text`` and the boolean ``held_out``. Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score
    (add-one unigrams) and score, log10 probabilities of the whole text. A null text is the empty one, whose one token is the end;
    a null ``held_out`` counts as false. Repeated rows are counted and scored as often as they stand there. Without training rows
    every token is the unknown word, of probability one. An empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text, F.coalesce(F.col(held_out), F.lit(False)).alias("held_out"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)), F.count(F.when(~F.col("held_out"), 1))).first()
    buckets = max(LEAST_BUCKETS, -(-int(size[0]) // (6 * BUCKET_TOKENS)))
    words = rows.mapInArrow(partial(_word_batches, buckets=buckets), "part int, data binary")

    most = max(64, (CODES - 16) // buckets)

    def add(group: pa.Table) -> pa.Table:
        return _add_words(group, most)

    words = written(
        words.groupBy("part").applyInArrow(
            add, "part int, data binary, total long, types long, with_count array<long>, top_words array<long>, top_counts array<long>"
        ),
        "katz-words",
    )
    stats = words.drop("data").collect()  # one short row per bucket
    total, types = sum(r["total"] for r in stats), sum(r["types"] for r in stats)
    model = WordModel(total, types, [sum(r["with_count"][k] for r in stats) for k in range(SMALL + 1)])
    tops = [(n, w) for r in stats for w, n in zip(r["top_words"], r["top_counts"])]
    coded = np.array(sorted(w for _, w in sorted(tops, reverse=True)[: CODES - 16]), np.uint64)
    common = {w: n for r in stats for w, n in zip(r["top_words"], r["top_counts"]) if n * buckets * 4 > total}  # under 4 x buckets words
    sent = np.array(sorted(common), np.uint64)
    parts = rows.mapInArrow(partial(_bigram_batches, buckets=buckets, common=sent, coded=coded), _PART)
    parts = parts.unionByName(words.select(F.lit(0).alias("kind"), "part", F.lit(0).cast("long").alias("chunk"), "data"))

    def count(group: pa.Table) -> pa.Table:
        return _count_bucket(group, model, common, buckets)

    counted = written(parts.groupBy("part").applyInArrow(count, _PART), "katz-counts", compression="zstd")
    discard(words)
    found = [_unpack(bytes(r["data"]), "<i8")[0] for r in counted.where("kind = 4").select("data").collect()]  # one short row per bucket
    d = discounts(np.sum(found, axis=0).tolist() if found else [0] * (SMALL + 1))

    def weigh(group: pa.Table) -> pa.Table:
        return _weigh_bucket(group, d)

    def finish(group: pa.Table) -> pa.Table:
        return _finish_chunk(group, d, total, types, size[1])

    weighed = counted.where("kind < 2").groupBy("part").applyInArrow(weigh, _PART)
    chunks = counted.where("kind IN (2, 3)").unionByName(weighed)
    return chunks.groupBy("chunk").applyInArrow(
        finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
