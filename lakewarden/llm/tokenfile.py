"""Token ids in fixed-width bit-packed files.

A file holds a run of documents in ascending order of their ids:

* blocks of ``BLOCK_IDS`` ids (the last one fewer), each id in the fewest bits that hold every id of
  the vocabulary, eight ids in as many bytes as an id has bits, least significant bit first;
* the index: document ids, the place of each document among the file's ids and the end of the last
  one, the byte offset of each block and the end of the last one (signed 64-bit), and one byte per
  document that tells whether its id is null;
* the footer: magic, then documents, ids, blocks, offset of the index, bits per id, ids per block.

A line end follows each block, the index and the footer, for Spark's text writer writes the files:
its commit protocol makes them whole even if executors are lost, on any file system Spark can reach.
All numbers are little-endian. Any id is found by its block's offset; blocks unpack in numpy.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakewarden.llm.common import saved, small_batches, table
from lakewarden.llm.tokens import encoder
from lakewarden.session import new_folder

BLOCK_IDS = 1 << 16
MAGIC = b"LWBITS01"
FOOTER = struct.Struct("<8sQQQQQQ")
#: Text per file. A file is read whole, so this bounds what a reader holds.
FILE_TEXT_BYTES = 24 << 20


def width_of(vocabulary: int) -> int:
    """Bits that hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def _places(width: int) -> Iterator[tuple[int, int, list[int]]]:
    """For each of eight ids: its number, the shift within its first byte, and the bytes it touches."""
    for k in range(8):
        first, shift = divmod(k * width, 8)
        yield k, shift, list(range(first, first + (shift + width + 7) // 8))


def pack(ids: np.ndarray, width: int) -> bytes:
    groups = -(-len(ids) // 8)
    padded = np.zeros(groups * 8, np.uint64)
    padded[: len(ids)] = ids
    out = np.zeros((groups, width), np.uint8)
    for k, shift, touched in _places(width):
        value = padded[k::8] << np.uint64(shift)
        for j, byte in enumerate(touched):
            out[:, byte] |= ((value >> np.uint64(8 * j)) & np.uint64(255)).astype(np.uint8)
    return out.tobytes()


def unpack(packed: bytes, count: int, width: int) -> np.ndarray:
    groups = -(-count // 8)
    source = np.frombuffer(packed, np.uint8, groups * width).reshape(groups, width)
    out = np.empty((groups, 8), np.uint32)
    for k, shift, touched in _places(width):
        value = np.zeros(groups, np.uint64)
        for j, byte in enumerate(touched):
            value |= source[:, byte].astype(np.uint64) << np.uint64(8 * j)
        out[:, k] = (value >> np.uint64(shift)) & np.uint64((1 << width) - 1)
    return out.reshape(-1)[:count]


class TokenFile:
    """Random access to one file's content."""

    def __init__(self, content: bytes):
        self.content = memoryview(content)
        magic, docs, self.count, blocks, at, self.width, self.block = FOOTER.unpack_from(content, len(content) - FOOTER.size - 1)
        if magic != MAGIC:
            raise ValueError("not a token file")
        self.doc_ids = np.frombuffer(content, "<i8", docs, at)
        self.starts = np.frombuffer(content, "<i8", docs + 1, at + 8 * docs)
        self.offsets = np.frombuffer(content, "<i8", blocks + 1, at + 8 * (2 * docs + 1))
        self.no_id = np.frombuffer(content, np.uint8, docs, at + 8 * (2 * docs + blocks + 2)).astype(bool)

    def block_ids(self, number: int) -> np.ndarray:
        count = min(self.block, self.count - number * self.block)
        return unpack(self.content[self.offsets[number] : self.offsets[number + 1]], count, self.width)

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids ``start`` to ``end`` (exclusive) of the file."""
        if start >= end:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (end - 1) // self.block
        joined = np.concatenate([self.block_ids(n) for n in range(first, last + 1)])
        return joined[start - first * self.block : end - first * self.block]

    def document(self, number: int) -> np.ndarray:
        return self.ids(int(self.starts[number]), int(self.starts[number + 1]))

    def documents(self) -> Iterator[np.ndarray]:
        """The ids of each document in turn; each block is unpacked once."""
        held, begin, number = np.zeros(0, np.uint32), 0, 0
        for start, end in zip(self.starts[:-1].tolist(), self.starts[1:].tolist(), strict=True):
            while begin + len(held) < end:
                held = np.concatenate([held[start - begin :], self.block_ids(number)])
                begin, number = start, number + 1
            yield held[start - begin : end - begin]


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same texts with ``end_id`` after each."""
    stops = np.cumsum(counts)
    return np.insert(ids, stops, end_id), counts + 1


def _file_rows(path: str, end_id: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The parts of one file as rows, to be written one after the other."""
    tokenizer = encoder(path)
    width = width_of(max(tokenizer.size, end_id + 1))
    doc_ids, no_id, lengths, offsets = [], [], [], [0]
    held, count = np.zeros(0, np.uint32), 0

    def row(part: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([part], pa.binary())], ["value"])

    for batch in batches:
        ids_of = batch.column("doc_id")
        no_id.append(ids_of.is_null().to_numpy(zero_copy_only=False))
        doc_ids.append(ids_of.fill_null(0).to_numpy())
        for ids, counts in tokenizer.encode(batch.column("text")):
            ids, counts = with_end(ids, counts, end_id)
            lengths.append(counts)
            count += len(ids)
            held = np.concatenate([held, ids])
            for at in range(0, len(held) - BLOCK_IDS + 1, BLOCK_IDS):
                part = pack(held[at : at + BLOCK_IDS], width)
                offsets.append(offsets[-1] + len(part) + 1)
                yield row(part)
            held = held[len(held) // BLOCK_IDS * BLOCK_IDS :]
    if len(held):
        part = pack(held, width)
        offsets.append(offsets[-1] + len(part) + 1)
        yield row(part)
    starts = np.append(0, np.cumsum(np.concatenate(lengths or [[]]))).astype("<i8")
    docs = np.concatenate(doc_ids or [[]]).astype("<i8")
    index = docs.tobytes() + starts.tobytes() + np.array(offsets, "<i8").tobytes() + np.concatenate(no_id or [[]]).astype(np.uint8).tobytes()
    yield row(index)
    yield row(FOOTER.pack(MAGIC, len(docs), count, len(offsets) - 1, offsets[-1], width, BLOCK_IDS))


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int, file_text_bytes: int = FILE_TEXT_BYTES) -> None:
    """Write (doc_id, text) as token files; the files, in order of name, hold ascending document ids.

    A null text is empty. Null ids come first. Rows that share an id are all kept, in the order of
    their texts' hashes, which also lets them be spread over files.
    """
    tie = F.xxhash64("text").alias("_tie")
    read = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"), tie)
    size = read.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(1, -(-size // file_text_bytes))
    dealt = read.repartitionByRange(files, "doc_id", "_tie").sortWithinPartitions("doc_id", "_tie")
    rows = dealt.select("doc_id", "text").mapInArrow(partial(_file_rows, tokenizer, end_id), "value binary")
    with small_batches(docs.sparkSession):
        rows.select(F.col("value").cast("string")).write.text(folder)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for file, content in zip(batch.column("file"), batch.column("content"), strict=True):
            tokens = TokenFile(content.as_buffer().to_pybytes())
            crc = [zlib.crc32(ids.astype("<u4").tobytes()) for ids in tokens.documents()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([file.as_py()] * len(crc), pa.int64()),
                    pa.array(tokens.doc_ids, pa.int64(), mask=tokens.no_id),
                    pa.array(tokens.starts[:-1], pa.int64()),
                    pa.array(np.diff(tokens.starts), pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                ["file", "doc_id", "place", "n_tokens", "ids_crc32"],
            )


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it. A file's ids are summed first; the running
    sum over files is over one row per file.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    number = F.regexp_extract("path", r"part-(\d+)", 1).cast("bigint").alias("file")
    schema = "file bigint, doc_id bigint, place bigint, n_tokens bigint, ids_crc32 bigint"
    with small_batches(spark, 1):
        docs = saved(files.select(number, "content").mapInArrow(_read, schema), "token-digests")
    sums = docs.groupBy("file").agg(F.sum("n_tokens").alias("ids"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    start = (F.col("base") + F.col("place")).alias("start")
    return docs.join(bases, "file").select("doc_id", start, "n_tokens", "ids_crc32")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents as token files and describe each document from what is read back."""
    folder = new_folder(spark, "token-files")
    write(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return read_digests(spark, folder)
