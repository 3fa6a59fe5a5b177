"""Packing by minimum bin slack.

Each task packs its own documents: it reads them in order, keeps a pool of pieces that wait for a
window, bounded in number and tokens, and fills window after window from it. A window takes the longest
piece that waits, and then the multiset of remaining lengths that comes closest to its capacity: a
dynamic program over subset sums, whose sets of reachable sums are the bits of one integer per step,
finds the closest sum, and walking the steps backwards gives how often each length is taken.

A window that no multiset fills takes the beginning of a longer piece, whose rest waits on. At the end
of a task the last window is dealt into sequences whose sizes are powers of two, which need no padding.
So no sequence is padded, whatever the lengths; where short pieces wait, sums are exact and hardly a
document is cut but those longer than a window.

Nothing is shuffled or stored on the way: a task needs no other task's lengths.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from functools import partial

import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewarden.llm.common import saved, small_batches, table
from lakewarden.llm.tokenfile import with_end
from lakewarden.llm.tokens import encoder

CAPACITY = 2048
#: Tokens and pieces that may wait in a task for a window.
WAITING, PIECES_WAITING = 1_000_000, 100_000
#: Tokens of one batch of results.
TOKENS_OUT = 500_000
#: Sequence ids of a task start at its number times this.
PER_TASK = 1 << 36
PIECES = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids binary, sequence_id bigint, offset bigint"


def closest_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """How often to take each length, at most ``counts`` times, for the largest sum up to ``room``.

    Longer lengths are tried first, and the search ends once the sum is exact: of equal sums it finds
    one of long pieces, which leaves short ones to close later windows.
    """
    target, mask = 1 << room, (2 << room) - 1
    reached = 1
    steps: list[tuple[int, int, int]] = []
    for length in sorted(counts, reverse=True):
        left = min(counts[length], room // length)
        times = 1
        # Shares of 1, 2, 4, ... make every count up to the limit.
        while left and not reached & target:
            times = min(times, left)
            steps.append((length, times, reached))
            reached |= (reached << length * times) & mask
            left -= times
            times *= 2
    total = reached.bit_length() - 1
    taken: dict[int, int] = {}
    for length, times, before in reversed(steps):
        if not before >> total & 1:
            taken[length] = taken.get(length, 0) + times
            total -= length * times
    return taken


class Pool:
    """Pieces (owner, start, length) that wait, by length."""

    def __init__(self) -> None:
        self.by_length: dict[int, deque] = {}
        self.tokens = self.pieces = 0

    def add(self, piece: tuple) -> None:
        self.by_length.setdefault(piece[2], deque()).append(piece)
        self.tokens += piece[2]
        self.pieces += 1

    def take(self, length: int) -> tuple:
        waiting = self.by_length[length]
        piece = waiting.popleft()
        if not waiting:
            del self.by_length[length]
        self.tokens -= length
        self.pieces -= 1
        return piece

    def window(self, capacity: int) -> list[tuple]:
        """The longest piece, and those that fill the window best with it."""
        first = self.take(max(self.by_length))
        counts = {n: len(waiting) for n, waiting in self.by_length.items()}
        taken = closest_fill(counts, capacity - first[2])
        return [first, *[self.take(n) for n, times in taken.items() for _ in range(times)]]


def _cut(piece: tuple, length: int) -> tuple[tuple, tuple]:
    owner, start, whole = piece
    return (owner, start, length), (owner, start + length, whole - length)


def by_powers(pieces: list[tuple]) -> Iterator[list[tuple]]:
    """The pieces dealt into sequences whose sizes are the powers of two of their sum, cut where needed."""
    total, left = sum(p[2] for p in pieces), deque(pieces)
    for power in reversed(range(total.bit_length())):
        room = total & 1 << power
        out = []
        while room:
            piece = left.popleft()
            if piece[2] > room:
                piece, rest = _cut(piece, room)
                left.appendleft(rest)
            out.append(piece)
            room -= piece[2]
        if out:
            yield out


def windows(pieces: Iterator[tuple], capacity: int = CAPACITY, waiting: int = WAITING) -> Iterator[list[tuple]]:
    """Pack pieces (owner, start, length), none longer than ``capacity``; yield the pieces of each sequence.

    All sequences but a last few are full; those have sizes that are powers of two. Only about
    ``waiting`` tokens are held.
    """
    pool = Pool()
    for piece in pieces:
        if piece[2] == capacity:
            yield [piece]
            continue
        pool.add(piece)
        # One window at a time, so that many lengths stay to choose from.
        if pool.tokens >= max(waiting, 2 * capacity) or pool.pieces >= max(PIECES_WAITING, 2 * capacity):
            yield _filled(pool, pool.window(capacity), capacity)
    while pool.tokens >= capacity:
        yield _filled(pool, pool.window(capacity), capacity)
    rest = [pool.take(n) for n in sorted(pool.by_length, reverse=True) for _ in range(len(pool.by_length[n]))]
    yield from by_powers(rest)


def _filled(pool: Pool, chosen: list[tuple], capacity: int) -> list[tuple]:
    """The window, closed by the beginning of a waiting piece where no multiset fills it."""
    slack = capacity - sum(p[2] for p in chosen)
    if not slack:
        return chosen
    # Whatever still waits is longer than the slack, or the dynamic program had taken it.
    part, rest = _cut(pool.take(min(pool.by_length)), slack)
    pool.add(rest)
    return [*chosen, part]


def _documents(tokenizer, end_id: int, batches: Iterator[pa.RecordBatch], capacity: int) -> Iterator[tuple]:
    """Pieces of each text: whole windows, then what is left.

    A piece owns a copy of its ids, so that one that waits does not hold its document: its owner is
    (doc_id, ids of the document, place of the first id, bytes of the ids).
    """
    for batch in batches:
        doc_ids = batch.column("doc_id").to_pylist()
        row = 0
        for ids, counts in tokenizer.encode(batch.column("text")):
            ids, counts = with_end(ids, counts, end_id)
            ids = ids.astype("<u4")
            at = 0
            for n in counts.tolist():
                for start in range(0, n, capacity):
                    length = min(capacity, n - start)
                    yield (doc_ids[row], n, start, ids[at + start : at + start + length].tobytes()), 0, length
                at += n
                row += 1


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
    names = [part.split()[0] for part in PIECES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def _packed(path: str, end_id: int, capacity: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sequence = TaskContext.get().partitionId() * PER_TASK
    out: list[tuple] = []
    tokens = 0
    for chosen in windows(_documents(encoder(path), end_id, batches, capacity), capacity):
        offset = 0
        for (doc_id, whole, first, ids), start, length in chosen:
            out.append((doc_id, first + start, length, whole, ids[4 * start : 4 * (start + length)], sequence, offset))
            offset += length
        sequence += 1
        tokens += offset
        if tokens >= TOKENS_OUT:
            yield _batch(out)
            out, tokens = [], 0
    if out:
        yield _batch(out)


def pack_windows(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """Tokenize (doc_id, text) and pack into sequences of at most ``capacity`` ids: one row per piece.

    A piece has its document's ``doc_id`` and ``doc_tokens`` (ids of the whole document, end id
    included), its ``start`` in it, ``length`` and ``ids`` (unsigned 32-bit, little-endian), and its
    ``sequence_id`` and ``offset``. A null or empty text is its end id. Null and repeated ids are packed
    like others; an empty table gives no rows. Sequences fall short of ``capacity`` only at the end of
    a task, and then have sizes that are powers of two.
    """
    read = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    return read.mapInArrow(partial(_packed, tokenizer, end_id, capacity), PIECES)


def op12_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of at most 2048 ids, and describe each piece."""
    packed = pack_windows(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    described = packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
    with small_batches(spark):
        return saved(described, "packed-windows")
