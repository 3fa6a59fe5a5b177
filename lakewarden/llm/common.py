"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewarden.session import new_folder

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that numpy works on at a time; bounds its temporary arrays.
SLICE_BYTES = 1 << 20
SPACE = 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to a new folder all executors share, and read back: lineage ends here."""
    folder = new_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Within the block, texts travel to Python workers in batches of at most ``rows``.

    For jobs that run inside the block; the session's own setting returns after it.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def remainder(key: str, divisor: int) -> Column:
    """Unsigned CRC-32 of the key as text, modulo ``divisor``; null for a null key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % divisor


def sample_key(*columns: str) -> Column:
    """A fixed pseudo-random order of rows."""
    return F.xxhash64(F.lit("sample"), *columns)


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


#: What workers keep for later tasks of one kind. Tasks that read texts without it drop it.
KEPT: list[dict] = []


def give_back() -> None:
    """Return memory of earlier batches to the system: a worker lives longer than its task."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def return_heap(spark: SparkSession) -> None:
    """Have the executors collect their garbage, so that a job starts with the heap in use and no more.

    A JVM keeps all heap it once took until a full collection, however little of it is in use, and the
    workers' memory comes on top. One task for each core, while no other job runs, reaches all executors;
    one that gets none only keeps its heap.
    """
    cores = spark.sparkContext.defaultParallelism
    spark.range(0, cores, 1, cores).select(F.java_method(F.lit("java.lang.System"), F.lit("gc"))).collect()


def in_parts(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``rows``; a worker gives back the memory of the last one, too.

    For jobs that begin where no setting of this library holds any more, see ``small_batches``.
    """
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
    give_back()


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; null is empty."""
    for kept in KEPT:
        kept.clear()
    give_back()
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or starts[0] == starts[-1]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def _segments(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(row, start, end) of pieces of at most ``SLICE_BYTES``, cut at a space where one is near."""
    for row, (start, end) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        while end - start > SLICE_BYTES:
            cut = start + SLICE_BYTES
            near = np.flatnonzero(data[cut - 4096 : cut] <= SPACE)
            cut = cut - 4096 + int(near[-1]) if len(near) else cut
            yield row, start, cut
            start = cut
        yield row, start, end


def slices(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Bounded slices of a string column as (bytes, rows, starts).

    ``rows[i]`` is the row whose piece begins at ``starts[i]``. A space stands before and after each
    piece, so no n-gram of a word crosses from one to the next.
    """
    held: list[tuple[int, int, int]] = []
    size = 0

    def packed():
        out = np.full(size + len(held) + 2, SPACE, np.uint8)
        starts = np.zeros(len(held), np.int64)
        at = 0
        for k, (_, start, end) in enumerate(held):
            starts[k] = at
            out[at + 1 : at + 1 + end - start] = data[start:end]
            at += end - start + 1
        return out, np.array([row for row, _, _ in held]), starts

    for piece in _segments(data, offsets):
        held.append(piece)
        size += piece[2] - piece[1]
        if size >= SLICE_BYTES:
            yield packed()
            held, size = [], 0
    if held:
        yield packed()


#: ASCII letters become lower case, other ASCII a space; bytes of other letters stay.
FOLD = np.array([b | 0x20 if chr(b).isalpha() and b < 128 else SPACE if b < 128 else b for b in range(256)], np.uint8)


def ngram_buckets(folded: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Bucket of the n-gram of bytes at each place; 0 stands for n-grams with a space inside."""
    count = len(folded) - n + 1
    code = np.zeros(count, np.uint64)
    for i in range(n):
        code = (code << np.uint64(8)) | folded[i : i + count]
    bucket = ((code + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)
    spaces = np.cumsum(folded == SPACE, dtype=np.int32)
    # Spaces after the first byte and before the last; a pair of bytes has no inside.
    inside = spaces[n - 2 : n - 2 + count] - spaces[:count]
    blank = (folded[:count] == SPACE) & (folded[n - 1 : n - 1 + count] == SPACE)
    bucket[(inside > 0) | blank] = 0
    return bucket.astype(np.int32)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


WHITE = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
_random = np.random.default_rng(20240501)
_BYTE_KEYS = _random.integers(1, 2**64, 256, np.uint64, endpoint=False) | np.uint64(1)
_PLACE_KEYS = _random.integers(1, 2**64, 4096, np.uint64, endpoint=False) | np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits; one to one."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def words_of(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and 64-bit hashes of the words in bytes of text."""
    solid = ~WHITE[raw]
    edge = np.diff(np.concatenate([[False], solid, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return starts, ends, np.zeros(0, np.uint64)
    letters = raw[solid]
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(len(letters)) - np.repeat(first, lengths)
    sums = np.add.reduceat(_BYTE_KEYS[letters] * _PLACE_KEYS[place & 4095], first)
    return starts, ends, mix(sums + lengths.astype(np.uint64))
