"""Shared by the operators: intermediate tables, the word rule and vectorised hashing of words and shingles."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack.session import ensure_checkpoint_dir

#: Bytes of text that are hashed at once; bounds the memory of a task, not the length of a text.
PIECE_BYTES = 512 * 1024

WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which the driver and all executors can reach."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return configured or ensure_checkpoint_dir(spark)


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/tamarack-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder: lost executors cost no recompute, and later reads prune columns."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path, **options)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete tables from :func:`written` that no later step reads, so that the shared folder holds what is in use only."""
    for frame in frames:
        if place := getattr(frame, "written_to", None):
            path = frame.sparkSession._jvm.org.apache.hadoop.fs.Path(place)
            path.getFileSystem(frame.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(column: Column) -> Column:
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc_fold(column: str, folds: int) -> Column:
    """crc32 of the column as text, modulo ``folds``; null counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def words(text: str | None) -> list[bytes]:
    """Words of a text: A-Z lower-cased, split at the ASCII white space 0x20 and 0x09 to 0x0D."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective mixer of unsigned 64-bit numbers (the splitmix64 finaliser)."""
    h = h.copy()
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def tidy() -> None:
    """Free what earlier tasks of a worker have left.

    Code that is shipped by value brings its own module state into each task. That state is part of reference cycles, which large
    arrays in it do not make Python collect any sooner.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # freed arrays of a few MB stay in the C library's heap otherwise
        trim(0)


def tidied(run: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """The batch function, which finds its worker tidy and leaves it so: more workers wait than run, and each keeps what it held."""

    @wraps(run)
    def clean(batches: Iterator[pa.RecordBatch], *args: object, **kwargs: object) -> Iterator[pa.RecordBatch]:
        tidy()
        try:
            yield from run(batches, *args, **kwargs)
        finally:
            tidy()

    return clean


_BASE = 0x9E3779B97F4A7C15 | 1
_STATE: dict[str, np.ndarray] = {}


def _tables() -> dict[str, np.ndarray]:
    if not _STATE:
        tidy()
        byte = np.arange(256, dtype=np.uint8)
        _STATE["lower"] = np.where((byte >= 65) & (byte <= 90), byte + 32, byte).astype(np.uint8)
        _STATE["space"] = (byte == 32) | ((byte >= 9) & (byte <= 13))
        _STATE["value"] = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
        _STATE["value"] = _STATE["value"][_STATE["lower"]]
        _STATE["power"] = np.ones(1, np.uint64)
    return _STATE


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    t = _tables()
    if len(t["power"]) < n or "inverse" not in t:
        size = max(n, PIECE_BYTES + 1)
        inverse = pow(_BASE, -1, 2**64)
        for name, base in (("power", _BASE), ("inverse", inverse)):
            row = np.full(size, np.uint64(base), np.uint64)
            row[0] = 1
            t[name] = np.multiply.accumulate(row)
    return t["power"], t["inverse"]


def _hash_piece(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word of ``data``, and the number of words between successive ``edges``."""
    t = _tables()
    power, inverse = _powers(len(data) + 1)
    gap = t["space"][data]
    before = np.empty(len(data) + 1, bool)
    before[0] = True
    before[1:] = gap
    after = np.empty(len(data) + 1, bool)
    after[:-1] = gap
    after[-1] = True
    before[edges] = True
    after[edges] = True
    inside = ~gap
    starts = np.flatnonzero(inside & before[:-1])
    ends = np.flatnonzero(inside & after[1:]) + 1
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(t["value"][data] * power[: len(data)], out=total[1:])
    hashes = mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    return hashes, np.diff(np.searchsorted(starts, edges))


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row borders of a string column; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, borders, data = column.buffers()
    borders = np.frombuffer(borders, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[borders[0] : borders[-1]], borders - borders[0]


def _spans(data: np.ndarray, borders: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """Successive (first row, end row, first byte, end byte); a text longer than a piece is cut at white space."""
    space, rows, row = _tables()["space"], len(borders) - 1, 0
    while row < rows:
        end = max(row + 1, int(np.searchsorted(borders, borders[row] + PIECE_BYTES, "right")) - 1)
        first, last = int(borders[row]), int(borders[end])
        while last - first > 2 * PIECE_BYTES:
            cut = first + PIECE_BYTES
            while cut < last and not (ahead := space[data[cut : min(last, cut + 65536)]]).any():
                cut = min(last, cut + 65536)
            cut = min(last, cut + int(ahead.argmax())) if cut < last else last
            yield row, end, first, cut
            first = cut
        if first < last or end > row:
            yield row, end, first, last
        row = end


def word_hashes(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, hashes of all their words in order, number of words of each row), in bounded pieces.

    A word's hash depends on its lower-cased bytes alone.
    """
    data, borders = _buffers(column)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for row, end, first, last in _spans(data, borders):
        edges = np.clip(borders[row : end + 1] - first, 0, last - first)
        got = _hash_piece(data[first:last], edges)
        held.append(got)
        if last == borders[end]:
            yield row, end, np.concatenate([h for h, _ in held]), np.sum([n for _, n in held], axis=0).astype(np.int64)
            held = []


def shingle_hashes(hashes: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``width`` words within a row, and how many each row has.

    A row with fewer words, but at least one, has its whole sequence as its one shingle.
    """
    n = len(hashes)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(counts), np.int64)
    ends = np.cumsum(counts)
    room = np.repeat(ends, counts) - np.arange(n)  # words from here to the end of the row
    value = np.zeros(n, np.uint64)
    for k in range(min(width, n)):
        value[: n - k] = value[: n - k] * np.uint64(_BASE) + hashes[k:]
    keep = room >= width
    short = np.flatnonzero((counts > 0) & (counts < width))
    for row in short:
        at = ends[row] - counts[row]
        whole = 0
        for h in hashes[at : ends[row]]:
            whole = (whole * _BASE + int(h)) % 2**64
        value[at] = (whole + int(counts[row])) % 2**64
        keep[at] = True
    number = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    value += np.uint64(width) * (room >= width)  # as the whole sequence of a row that long has it
    return mix(value[keep]), number


def shingle_sets(column: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, sorted distinct shingle hashes of the next rows one after the other, size of each row's set)."""
    for row, _, hashes, counts in word_hashes(column):
        values, number = shingle_hashes(hashes, counts, width)
        owner = np.repeat(np.arange(len(number)), number)
        order = np.lexsort((values, owner))
        values, owner = values[order], owner[order]
        fresh = np.ones(len(values), bool)
        fresh[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
        yield row, values[fresh], np.bincount(owner[fresh], minlength=len(number)).astype(np.int64)


def signed(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values).view(np.int64)


def list_column(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """An Arrow list column whose rows hold the next ``sizes`` of ``values``."""
    borders = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=borders[1:])
    return pa.ListArray.from_arrays(pa.array(borders), pa.array(values))
