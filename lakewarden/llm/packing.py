"""Best-fit packing of documents into sequences by a linear grouping scheme.

Only lengths matter for the plan, and there are at most as many as a sequence has tokens. So the
corpus is reduced to a histogram of lengths, in Spark, and the plan is made from that:

1. large lengths are dealt into groups of equal cardinality, and each is rounded up to the largest
   of its group (linear grouping);
2. configurations of rounded lengths are chosen one after the other: the largest length left, and
   with it those that fill the sequence best; each is used as often as its lengths allow;
3. actual documents take the places of the rounded lengths, which leaves room;
4. small lengths go, largest first, to the sequence with the least room that holds them.

The plan says, for a run of documents of one length, which run of sequences takes them and at which
offset. Its size depends on the number of lengths and groups, not on the corpus. Each document finds
its sequence by its rank among those of its length; ranks are counted in salted groups, so a length
that most documents share is spread over tasks.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakewarden.llm.common import give_back, saved, small_batches, table
from lakewarden.llm.tokenfile import with_end
from lakewarden.llm.tokens import encoder

CAPACITY = 2048
GROUPS = 1024
#: Lengths above this share of a sequence are large.
LARGE = 1 / 16
SALTS = 256
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, salt int"


def cut_points(n: int, capacity: int) -> list[int]:
    """Bounds of the pieces of ``n`` ids: all full but the first, which takes the remainder."""
    first = n % capacity or capacity
    return [0, *range(first, n + 1, capacity)]


def _pieces(path: str, end_id: int, capacity: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tokenizer = encoder(path)
    salt = TaskContext.get().partitionId()
    for batch in batches:
        doc_ids = batch.column("doc_id").to_pylist()
        row = 0
        out: list[tuple] = []
        for ids, counts in tokenizer.encode(batch.column("text")):
            ids, counts = with_end(ids, counts, end_id)
            ids = ids.astype("<u4")
            at = 0
            for n in counts.tolist():
                bounds = cut_points(n, capacity)
                for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                    salt += 1
                    out.append((doc_ids[row], k, a, b - a, zlib.crc32(ids[at + a : at + b].tobytes()), salt % SALTS))
                at += n
                row += 1
        columns = zip(*out, strict=True) if out else [[]] * 6
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
        arrays = [pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "start", "length", "ids_crc32", "salt"])
        del ids, counts, out, columns, arrays
        give_back()


def tokenized_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """One row per piece of each text's ids and end id; null text is empty."""
    read = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    return read.mapInArrow(partial(_pieces, tokenizer, end_id, capacity), PIECES)


@dataclass
class Run:
    """``count`` pieces of one length, from ``rank``, go to as many sequences from ``sequence``."""

    length: int
    rank: int
    count: int
    sequence: int
    offset: int


def _best_fill(sizes: list[int], left: dict[int, int], room: int) -> list[int]:
    """Sizes, no more often than left, whose sum comes closest to ``room``; larger ones are preferred."""
    reach, full = 1, 1 << room
    mask = (full << 1) - 1
    steps: list[tuple[int, int]] = []
    for size in sizes:
        if size > room:
            continue
        before = reach
        for _ in range(min(left[size], room // size)):
            grown = (reach | (reach << size)) & mask
            if grown == reach:
                break
            reach = grown
        if reach != before:
            steps.append((size, before))
        if reach & full:
            break
    total = reach.bit_length() - 1
    chosen = []
    for size, before in reversed(steps):
        while not before >> total & 1:
            chosen.append(size)
            total -= size
    return chosen


class _Plan:
    def __init__(self, capacity: int):
        self.capacity = capacity
        self.runs: list[Run] = []
        self.sequences = 0
        self.next_rank: dict[int, int] = defaultdict(int)
        #: Runs of sequences (first, count) by the room they have left.
        self.room: dict[int, list[tuple[int, int]]] = defaultdict(list)

    def place(self, length: int, count: int, sequence: int, offset: int) -> None:
        self.runs.append(Run(length, self.next_rank[length], count, sequence, offset))
        self.next_rank[length] += count

    def open(self, count: int) -> int:
        self.sequences += count
        return self.sequences - count


def _groups(histogram: dict[int, int], groups: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """(rounded length, [(length, count), ...] largest first) for groups of equal cardinality."""
    total = sum(histogram.values())
    size = max(1, -(-total // groups))
    out: list[tuple[int, list[tuple[int, int]]]] = []
    space = 0
    for length in sorted(histogram, reverse=True):
        count = histogram[length]
        while count:
            if not space:
                out.append((length, []))
                space = size
            taken = min(count, space)
            out[-1][1].append((length, taken))
            count, space = count - taken, space - taken
    return out


def make_plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> tuple[list[Run], int]:
    """Runs that place every piece of the histogram, and the number of sequences."""
    plan = _Plan(capacity)
    if histogram.get(capacity):
        plan.place(capacity, histogram[capacity], plan.open(histogram[capacity]), 0)
    large = {n: c for n, c in histogram.items() if capacity * LARGE < n < capacity}
    small = {n: c for n, c in histogram.items() if n <= capacity * LARGE}
    members: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for rounded, group in _groups(large, groups):
        members[rounded] += group
    left = {rounded: sum(c for _, c in group) for rounded, group in members.items()}
    for group in members.values():
        group.reverse()
    sizes = sorted(left, reverse=True)
    while sizes:
        first = sizes[0]
        left[first] -= 1
        chosen = [first, *_best_fill(sizes, left, capacity - first)]
        left[first] += 1
        times = min(left[s] // chosen.count(s) for s in set(chosen))
        _substitute(plan, chosen, members, times)
        for s in chosen:
            left[s] -= times
        sizes = [s for s in sizes if left[s]]
    for length in sorted(small, reverse=True):
        _best_fit(plan, length, small[length])
    return plan.runs, plan.sequences


def _substitute(plan: _Plan, chosen: list[int], members: dict[int, list[tuple[int, int]]], times: int) -> None:
    """Put actual lengths into ``times`` sequences of one configuration."""
    first = plan.open(times)
    used = [(0, times, 0)]
    for size in chosen:
        queue = members[size]
        split = []
        for begin, count, offset in used:
            while count:
                length, there = queue.pop()
                taken = min(count, there)
                if there > taken:
                    queue.append((length, there - taken))
                plan.place(length, taken, first + begin, offset)
                split.append((begin, taken, offset + length))
                begin, count = begin + taken, count - taken
        used = split
    for begin, count, offset in used:
        if offset < plan.capacity:
            plan.room[plan.capacity - offset].append((first + begin, count))


def _best_fit(plan: _Plan, length: int, count: int) -> None:
    """Place small pieces into the sequences with the least sufficient room, opening new ones at need."""
    while count:
        room = min((r for r, runs in plan.room.items() if r >= length and runs), default=0)
        if not room:
            room = plan.capacity
            need = -(-count // (room // length))
            plan.room[room].append((plan.open(need), need))
        first, there = plan.room[room].pop()
        each = min(room // length, count)
        taken = min(there, count // each)
        if there > taken:
            plan.room[room].append((first + taken, there - taken))
        for k in range(each):
            plan.place(length, taken, first, plan.capacity - room + k * length)
        count -= each * taken
        if room > each * length:
            plan.room[room - each * length].append((first, taken))


def _assign(keys: np.ndarray, starts: np.ndarray, sequences: np.ndarray, offsets: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rank = batch.column("rank").to_numpy()
        at = np.searchsorted(keys, _key(batch.column("length").to_numpy(), rank), side="right") - 1
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(sequences[at] + rank - starts[at]), pa.array(offsets[at])],
            [*batch.schema.names[:-1], "sequence_id", "offset"],
        )


def _key(length: np.ndarray, rank: np.ndarray) -> np.ndarray:
    return (length.astype(np.uint64) << np.uint64(48)) | rank.astype(np.uint64)


def pack(pieces: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """Give each piece its ``sequence_id`` and ``offset``. ``pieces`` must be a stored table.

    The driver holds one count per length and the plan; the latter goes to all tasks.
    """
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    runs, _ = make_plan(histogram, capacity, groups)
    runs.sort(key=lambda r: (r.length, r.rank))
    columns = [np.array([getattr(r, name) for r in runs], np.int64) for name in ("length", "rank", "sequence", "offset")]
    counts = pieces.groupBy("length", "salt").count()
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    within = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece")) - 1
    ranked = pieces.withColumn("_within", within).join(bases, ["length", "salt"])
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    ranked = ranked.select(*names, (F.col("base") + F.col("_within")).alias("rank"))
    assign = partial(_assign, _key(columns[0], columns[1]), columns[1], columns[2], columns[3])
    schema = PIECES.replace("salt int", "sequence_id bigint, offset bigint")
    return ranked.mapInArrow(assign, schema)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY, batch_rows: int = 1000) -> DataFrame:
    """Tokenize, cut and pack (doc_id, text): one row per piece.

    Fewer ``batch_rows`` take less memory of a worker, and more time.

    Null and empty texts are one piece, their end id. Null and repeated ids are packed like others.
    """
    with small_batches(docs.sparkSession, batch_rows):
        pieces = saved(tokenized_pieces(docs, tokenizer, end_id, capacity), "pieces")
    return pack(pieces, capacity)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of at most 2048 ids."""
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
