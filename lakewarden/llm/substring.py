"""Exact removal of repeated passages by super-k-mer partitioning.

A window of ``window`` words is repeated if its words also start anywhere else. Consecutive windows
that share their minimiser, the smallest hash of a few words in a row, form a super-k-mer. Equal
windows have equal minimisers, so only super-k-mers of one minimiser need to meet.

1. Minimisers are counted. One that occurs once holds no repeated window; one whose super-k-mers are
   all the same text, more than once, holds nothing but repeated windows.
2. Of the others, each distinct super-k-mer travels once, as one packed string, to the bucket of its
   minimiser. There its windows are counted as strings.
3. Buckets with many super-k-mers are dealt into parts of bounded size. Each part reports its distinct
   windows, and those that several parts report are repeated too.
4. The repeated windows of each document come together, and the words they cover are left out.

Counts are combined in map tasks, and copies of a super-k-mer are one string, so passages that very
many documents share do not gather in one task. Texts are compressed where they are shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewarden.llm.common import saved, small_batches, table, utf8
from lakewarden.llm.shingles import whole_rows
from lakewarden.llm.superkmers import MER, content_hashes, split

WINDOW = 35
#: Super-k-mers of one minimiser that meet in one place.
BUCKET = 512


def _instances(window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = batch.column("key").to_numpy()
        for begin, _, raw, stops in whole_rows(*utf8(batch.column("text"))):
            _, _, rows, first, windows, minimiser = split(raw, stops, window)
            content = content_hashes(raw, first, windows + window - 1)
            word = np.searchsorted(rows, rows[first], side="left") if len(first) else first
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys[begin + rows[first]] if len(first) else np.zeros(0, np.int64)),
                    pa.array(minimiser.view(np.int64)),
                    pa.array(content.view(np.int64)),
                    pa.array((first - word).astype(np.int32)),
                    pa.array(windows.astype(np.int32)),
                ],
                ["key", "minimiser", "content", "first", "windows"],
            )


INSTANCE = "key bigint, minimiser bigint, content bigint, first int, windows int"


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packer = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        texts = [packer.compress((t.as_py() or "").encode()) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.binary())], [*batch.schema.names[:-1], "packed"])


def _words(packed: pa.Scalar) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(packed.as_buffer()).split()


def _strings(window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The packed string of each super-k-mer asked for."""
    for batch in batches:
        for packed, asked in zip(batch.column("packed"), batch.column("asked"), strict=True):
            words = _words(packed)
            wanted = asked.as_py()
            strings = [b" ".join(words[a["first"] : a["first"] + a["windows"] + window - 1]) for a in wanted]
            columns = [pa.array([a[c] for a in wanted], kind) for c, kind in (("minimiser", pa.int64()), ("part", pa.int32()), ("parts", pa.int32()), ("content", pa.int64()), ("copies", pa.int64()))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(strings, pa.binary())], ["minimiser", "part", "parts", "content", "copies", "words"])


STRING = "minimiser bigint, part int, parts int, content bigint, copies bigint, words binary"
#: A super-k-mer with the bits of its repeated windows; or, with a digest, a window of a part of a
#: bucket: its super-k-mer and bit, if it occurs once in the part.
FOUND = "minimiser bigint, content bigint, mask bigint, digest binary"


def _windows(words: bytes, window: int) -> list[bytes]:
    spaces = [-1, *(i for i, b in enumerate(words) if b == 32), len(words)]
    return [words[spaces[i] + 1 : spaces[i + window]] for i in range(len(spaces) - window)]


def _bucket(window: int, rows: list[tuple]) -> list[tuple]:
    minimiser, _, parts, _, _, _ = rows[0]
    strings = {content: (copies, words) for _, _, _, content, copies, words in rows}
    masks = dict.fromkeys(strings, 0)
    seen: dict[bytes, tuple[int, int]] = {}
    repeated: set[bytes] = set()
    for content, (copies, words) in strings.items():
        own = _windows(words, window)
        if copies > 1:
            masks[content] = (1 << len(own)) - 1
        for i, text in enumerate(own):
            if text in seen:
                other, j = seen[text]
                masks[other] |= 1 << j
                masks[content] |= 1 << i
                repeated.add(text)
            else:
                seen[text] = (content, i)
                if copies > 1:
                    repeated.add(text)
    out = [(minimiser, content, mask, None) for content, mask in masks.items() if mask]
    if parts > 1:
        for text, (content, i) in seen.items():
            digest = hashlib.sha256(text).digest()[:16]
            out.append((minimiser, content, 0 if text in repeated else 1 << i, digest))
    return out


def _buckets(window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come ordered by minimiser and part; the last bucket of a batch may go on in the next."""
    held: list[tuple] = []

    def done(found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found, strict=True)) if found else [[]] * 4
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], ["minimiser", "content", "mask", "digest"])

    for batch in batches:
        found: list[tuple] = []
        for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if held and held[0][:2] != row[:2]:
                found += _bucket(window, held)
                held = []
            held.append(row)
        yield done(found)
    if held:
        yield done(_bucket(window, held))


def _kept(window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        totals, removed, digests, texts = [], [], [], []
        for packed, hits in zip(batch.column("packed"), batch.column("hits"), strict=True):
            words = _words(packed)
            edges = np.zeros(len(words) + 1, np.int64)
            for hit in hits.as_py() or ():
                mask, at = hit["mask"], hit["first"]
                for i in range(mask.bit_length()):
                    if mask >> i & 1:
                        edges[at + i] += 1
                        edges[at + i + window] -= 1
            covered = np.cumsum(edges[:-1]) > 0
            left = [w for w, c in zip(words, covered.tolist(), strict=True) if not c] if hits.is_valid else words
            text = b" ".join(left)
            totals.append(len(words))
            removed.append(len(words) - len(left))
            digests.append(hashlib.sha256(text).hexdigest())
            texts.append(text.decode())
        arrays = [batch.column("doc_id"), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string()), pa.array(texts, pa.string())]
        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])


def remove_repeated(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, n_removed, kept_sha256, kept_text.

    Words are runs of anything but ASCII white space; a null text has none. ``kept_text`` has the words
    that no repeated window covers, one space between them. Windows are judged on the input. Rows are
    told apart by id and text; rows that repeat both are occurrences of their own and get the same
    result. ``window`` is 6 to 66 words.
    """
    if not MER < window <= MER + 61:
        raise ValueError("window must be 6 to 66 words")
    spark = docs.sparkSession
    read = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("doc_id", "text").alias("key"), "text")
    instances = read.select("key", "text").mapInArrow(partial(_instances, window), INSTANCE)
    counts = instances.groupBy("minimiser").agg(F.count("*").alias("n"), F.min("content").alias("low"), F.max("content").alias("high"))
    with small_batches(spark, 2000):
        repeated = saved(counts.where(F.col("n") > 1).select("minimiser", (F.col("low") == F.col("high")).alias("whole")), "repeated-minimisers")
        open_ = saved(instances.join(repeated, "minimiser"), "repeated-super-k-mers")
    contents = open_.where(~F.col("whole")).groupBy("minimiser", "content").agg(
        F.count("*").alias("copies"), F.first("key").alias("key"), F.first("first").alias("first"), F.first("windows").alias("windows")
    )
    contents = saved(contents, "distinct-super-k-mers")
    large = contents.groupBy("minimiser").count().where(F.col("count") > BUCKET)
    large = large.select("minimiser", F.ceil(F.col("count") / BUCKET).cast("int").alias("parts"))
    dealt = contents.join(large, "minimiser", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    part = F.pmod(F.xxhash64("content"), F.col("parts")).cast("int")
    asked = F.struct("first", "windows", "minimiser", part.alias("part"), "parts", "content", "copies")
    wanted = dealt.groupBy("key").agg(F.collect_list(asked).alias("asked"))
    strings = read.select("key", "text").mapInArrow(_compressed, "key bigint, packed binary").join(wanted, "key")
    strings = strings.select("packed", "asked").mapInArrow(partial(_strings, window), STRING)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt_out = strings.repartition(partitions, "minimiser", "part").sortWithinPartitions("minimiser", "part")
    with small_batches(spark, 2000):
        found = saved(dealt_out.mapInArrow(partial(_buckets, window), FOUND), "repeated-windows")
    # Windows that several parts of a bucket hold.
    apart = found.where(F.col("digest").isNotNull())
    several = apart.groupBy("minimiser", "digest").count().where(F.col("count") > 1).select("minimiser", "digest")
    single = apart.where(F.col("mask") != 0)
    several = single.join(several, ["minimiser", "digest"], "left_semi").select("minimiser", "content", "mask")
    masks = found.where(F.col("digest").isNull()).select("minimiser", "content", "mask").unionByName(several)
    masks = saved(masks.groupBy("minimiser", "content").agg(F.bit_or("mask").alias("mask")), "repeated-masks")
    full = F.expr("shiftleft(1L, windows) - 1").alias("mask")
    hits = open_.where("whole").select("key", "first", full).unionByName(
        open_.where(~F.col("whole")).join(masks, ["minimiser", "content"]).select("key", "first", "mask")
    )
    # Rows that repeat id and text have the same hits once each.
    hits = hits.groupBy("key").agg(F.collect_set(F.struct("first", "mask")).alias("hits"))
    texts = read.select("key", "doc_id", "text").mapInArrow(_compressed, "key bigint, doc_id bigint, packed binary")
    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept_text string"
    return texts.join(hits, "key", "left").select("doc_id", "packed", "hits").mapInArrow(partial(_kept, window), schema)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove all words covered by 35-word windows that occur more than once."""
    return remove_repeated(table(spark, sf_dir, "documents")).drop("kept_text")


OP10_SQL = r"""
WITH
texts AS (
    SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
),
words AS (
    SELECT row, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i, len(w) AS words FROM texts
),
runs AS (
    SELECT row, i, word, CASE WHEN i + 34 <= words
        THEN string_agg(word, ' ') OVER (PARTITION BY row ORDER BY i ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING) END AS run
    FROM words
),
starts AS (
    SELECT row, i, word, run IS NOT NULL AND count(*) OVER (PARTITION BY run) > 1 AS repeated FROM runs
),
covered AS (
    SELECT row, i, word, bool_or(repeated) OVER (PARTITION BY row ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
    FROM starts
),
kept AS (
    SELECT row, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept_text
    FROM covered GROUP BY row
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept_text, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (row)
"""
