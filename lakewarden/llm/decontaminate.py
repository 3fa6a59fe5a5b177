"""Benchmark decontamination with a BM25 inverted index and block-max pruning.

Test items are cut into segments of bounded length and indexed: per term the segments that hold it
and the term's BM25 weight there, as a share of the weight of the whole segment. Document frequencies
and the average length are those of all segments of the benchmark. Every passage of
every document is a query; passages overlap so that any segment lies whole in one. A passage's score
for a segment is the share of the segment's weight that it holds.

Retrieval is block-max WAND. It is exact and returns what a search of the whole index would. The pivots
of all passages of a slice move at once, in numpy. Before, passages without a chance are left out by the
same greatest weights, of terms and of blocks. Frequent terms whose greatest weights together stay well below the
threshold are not essential: a passage that reaches the threshold must hold essential ones too, so
only these are looked at first. Passages that may reach it are bounded block by block of segments by
the greatest weight of each term in the block, and pivots are looked for in blocks that may still.

Retrieved items are verified on the text: the share of the word trigrams of the question, and of the
answer, the item's last sentence, that occur around the passage. Of fewer than three words, the whole
sequence has to occur. Numbers are words, and those of the item have to occur too: the same wording
with other numbers is another item. Commas between groups of three digits do not count. Scripts without spaces have a word per character.

The index stays with each task; it is built over at most ``SHARD`` items at a time, and a larger
benchmark takes one pass over the documents per shard. Shards do not change the result.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewarden.llm.common import FOLD, SPACE, mix, saved, table, utf8, words_of
from lakewarden.llm.shingles import whole_rows

SEGMENT = 64
#: Blocks of segments with a greatest weight of their own per term.
BLOCKS = 32
SHARD = 20_000
THRESHOLD = 0.5
#: Shares of the question's and of the answer's trigrams; a question alone must be mostly whole.
BOTH, ALONE = 0.5, 0.7
K1, B = 1.2, 0.75
SLOTS = 20
_KEYS = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)
SENTENCE = re.compile(r"(?<=[.!?])\s+|(?<=[。！？])|\n+")
DIGIT = np.array([48 <= b <= 57 for b in range(256)])
_FOLD = np.where(DIGIT, np.arange(256), FOLD).astype(np.uint8)


def _fold(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words in lower case, everything that is neither letter nor digit of theirs a space; and the places left out.

    A comma before a group of three digits is left out, so that a number is one word however it is written.
    """
    folded = _FOLD[raw]
    capital = np.append(False, raw[:-1] == 0xC3) & (raw >= 0x80) & (raw <= 0x9E) & (raw != 0x97)
    folded[capital] += 0x20
    digit = np.concatenate([DIGIT[raw], np.zeros(5, bool)])
    comma = np.flatnonzero(raw == 44)
    comma = comma[comma > 0]
    grouped = digit[comma - 1] & digit[comma + 1] & digit[comma + 2] & digit[comma + 3] & ~digit[comma + 4]
    gone = comma[grouped]
    return np.delete(folded, gone), gone


def _spread(folded: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded bytes with spaces around each character of a script without spaces, and where they were put in.

    Han, kana, Thai, Lao, Burmese and Khmer; CJK and full-width punctuation becomes space.
    """
    lead = np.flatnonzero(folded >= 0xE0)
    lead = lead[lead + 2 < len(folded)]
    if not len(lead):
        return folded, lead
    a, b, c = folded[lead], folded[lead + 1], folded[lead + 2]
    mark = ((a == 0xE3) & (b == 0x80)) | ((a == 0xEF) & (b == 0xBC) & ((c < 0x90) | ((c > 0x99) & (c < 0xA1))))
    han = ((a == 0xE3) & (b > 0x80)) | ((a > 0xE3) & (a < 0xEA)) | ((a == 0xEF) & (b >= 0xA4) & (b <= 0xAB)) | ((a == 0xF0) & (b >= 0xA0) & (b <= 0xB2))
    other = ((a == 0xE0) & (b >= 0xB8) & (b <= 0xBB)) | ((a == 0xE1) & (np.isin(b, (0x80, 0x81, 0x82, 0x9E, 0x9F))))
    folded[(lead[mark][:, None] + np.arange(3)).reshape(-1)] = SPACE
    alone = lead[han | other]
    at = np.unique(np.concatenate([alone, alone + np.where(folded[alone] >= 0xF0, 4, 3)]))
    return np.insert(folded, at, SPACE), at


def _words(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a text, and which of them hold a digit."""
    folded, _ = _spread(_fold(np.frombuffer(text.encode(), np.uint8))[0])
    starts, ends, hashes = words_of(folded)
    digits = np.append(0, np.cumsum(DIGIT[folded]))
    return hashes, digits[ends] > digits[starts]


def word_hashes(text: str) -> np.ndarray:
    return _words(text)[0]


def _grams(hashes: np.ndarray, width: int = 3) -> np.ndarray:
    """Hashes of ``width`` words in a row."""
    count = max(len(hashes) - width + 1, 0)
    return np.unique(mix(sum((hashes[j : j + count] * _KEYS[j] for j in range(width)), np.zeros(count, np.uint64))))


@dataclass
class Part:
    """What a question or an answer is verified on: its ``grams`` of ``width`` words, and its ``numbers``."""

    width: int
    grams: np.ndarray
    numbers: np.ndarray

    @staticmethod
    def of(hashes: np.ndarray, numbers: np.ndarray) -> Part:
        width = max(1, min(3, len(hashes)))
        return Part(width, _grams(hashes, width), np.intersect1d(hashes, numbers))

    def share(self, around: np.ndarray, grams: list[np.ndarray]) -> float:
        """Share of the grams among those of the words ``around``, by width; none where a number is missing."""
        if not len(self.grams) or not np.isin(self.numbers, around).all():
            return 0.0
        return np.isin(self.grams, grams[self.width - 1], assume_unique=True).mean()


def question_and_answer(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of an item's question and of its answer, the last sentence; of a single sentence, its last quarter.

    Each has three words at least; an item too short for that is both.
    """
    sentences = [s for s in SENTENCE.split(text) if len(word_hashes(s))]
    hashes = word_hashes(text)
    answer = len(word_hashes(sentences[-1])) if len(sentences) > 1 else len(hashes) // 4
    for least in (max(answer, 3), max(len(hashes) // 4, 3)):
        if len(hashes) - least >= 3:
            return hashes[: len(hashes) - least], hashes[len(hashes) - least :]
    return hashes, hashes


@dataclass
class Index:
    """``terms``: sorted word hashes. Postings of term t: ``segments``, ``weights`` from ``starts[t]`` on."""

    items: list[int]
    owner: np.ndarray
    terms: np.ndarray
    starts: np.ndarray
    segments: np.ndarray
    weights: np.ndarray
    keys: np.ndarray
    block: int
    block_max: np.ndarray
    greatest: np.ndarray
    essential: np.ndarray
    spare: float
    questions: list[Part] = field(default_factory=list)
    answers: list[Part] = field(default_factory=list)
    longest: int = 0

    def slots(self) -> np.ndarray:
        """Which leading bits of a hash belong to a term: most words are told apart by that."""
        out = np.zeros(1 << SLOTS, bool)
        out[self.terms >> np.uint64(64 - SLOTS)] = True
        return out


@dataclass
class Statistics:
    """Of all segments of a benchmark: their number, words and, for some sorted terms, how many hold each."""

    segments: int
    words: int
    terms: np.ndarray
    df: np.ndarray

    @staticmethod
    def of(texts: list[str]) -> Statistics:
        pieces = [piece for text in texts for piece in segments_of(word_hashes(text))]
        held = [np.unique(piece) for piece in pieces] or [np.zeros(0, np.uint64)]
        terms, df = np.unique(np.concatenate(held), return_counts=True)
        return Statistics(len(pieces), sum(map(len, pieces)), terms, df)


def segments_of(hashes: np.ndarray) -> list[np.ndarray]:
    """The words of an item in segments of bounded, nearly equal length."""
    return np.array_split(hashes, -(-len(hashes) // SEGMENT)) if len(hashes) else []


def build_index(items: list[tuple[int, str]], threshold: float = THRESHOLD, statistics: Statistics | None = None) -> Index | None:
    """The index of the items; without ``statistics`` they are the whole benchmark."""
    kept = [(number, text, word_hashes(text)) for number, text in items if text]
    kept = [k for k in kept if len(k[2])]
    if not kept:
        return None
    statistics = statistics or Statistics.of([text for _, text, _ in kept])
    owner, parts = [], []
    for at, (_, _, hashes) in enumerate(kept):
        for piece in segments_of(hashes):
            owner.append(at)
            parts.append(np.unique(piece, return_counts=True))
    lengths = np.array([c.sum() for _, c in parts], float)
    terms, number = np.unique(np.concatenate([t for t, _ in parts]), return_inverse=True)
    df = statistics.df[np.searchsorted(statistics.terms, terms)]
    segment = np.repeat(np.arange(len(parts)), [len(t) for t, _ in parts])
    tf = np.concatenate([c for _, c in parts]).astype(float)
    idf = np.log1p((statistics.segments - df + 0.5) / (df + 0.5))
    mean = statistics.words / statistics.segments
    weight = idf[number] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[segment] / mean))
    weight /= np.bincount(segment, weight)[segment]
    order = np.lexsort((segment, number))
    number, segment, weight = number[order], segment[order], weight[order]
    starts = np.searchsorted(number, np.arange(len(terms) + 1))
    greatest = np.maximum.reduceat(weight, starts[:-1])
    size = -(-len(parts) // BLOCKS)
    block_max = np.zeros((len(terms), -(-len(parts) // size)), np.float32)
    np.maximum.at(block_max, (number, segment // size), weight)
    frequent = np.argsort(-df, kind="stable")
    total = np.cumsum(greatest[frequent])
    spared = frequent[total <= 0.6 * threshold]
    essential = np.ones(len(terms), bool)
    essential[spared] = False
    index = Index([n for n, _, _ in kept], np.array(owner), terms, starts, segment, weight, number * len(parts) + segment, size, block_max, greatest, essential, float(greatest[spared].sum()))
    for _, text, hashes in kept:
        question, answer = question_and_answer(text)
        own, digits = _words(text)
        index.questions.append(Part.of(question, own[digits]))
        index.answers.append(Part.of(answer, own[digits]))
        index.longest = max(index.longest, len(hashes))
    return index


def _retrieve(index: Index, passages: np.ndarray, terms: np.ndarray, threshold: float) -> Iterable[tuple[int, dict[int, float]]]:
    """(passage, items with a segment of at least ``threshold`` of its weight in it, and the best share).

    ``terms`` are the distinct terms of each of the ``passages``, in order of these. Block-max WAND: each term
    has a cursor in its list of segments. The pivot is the first segment, in order of the cursors, up to which
    the terms' greatest weights reach the threshold; none before it can. Where those of the pivot's block reach
    it too, the pivot is scored; else the cursors skip to the end of the block or to the next term's segment,
    whichever comes first, and on to a block that reaches the threshold with all terms of the passage. One
    step moves the cursors of all passages.
    """
    count, bar = len(index.owner), threshold * (1 - 1e-5)
    starts = np.flatnonzero(np.append(True, passages[1:] != passages[:-1]))
    numbers = passages[starts]
    reach = np.add.reduceat(index.block_max[terms], starts, axis=0) >= bar
    # The first segment of the next block in reach, from each block on.
    ahead = np.where(reach, np.arange(reach.shape[1]) * index.block, count)
    ahead = np.append(np.minimum.accumulate(ahead[:, ::-1], axis=1)[:, ::-1], np.full((len(reach), 1), count), axis=1)
    passages = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(passages))))
    rows = ahead[passages, 0] < count
    passages, terms = passages[rows], terms[rows]
    ends, found = index.starts[terms + 1], defaultdict(dict)

    def moved(terms: np.ndarray, ends: np.ndarray, to: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and segment of each term's first posting from a segment on; ``count`` at the end."""
        at = np.searchsorted(index.keys, terms * count + to)
        return at, np.where(at < ends, index.segments[np.minimum(at, len(index.segments) - 1)], count)

    head = moved(terms, ends, ahead[passages, 0])[1]
    while len(passages):
        order = np.lexsort((head, passages))
        passages, terms, ends, head = passages[order], terms[order], ends[order], head[order]
        starts = np.flatnonzero(np.append(True, passages[1:] != passages[:-1]))
        sizes = np.diff(np.append(starts, len(passages)))
        sums = np.cumsum(np.where(head < count, index.greatest[terms], 0.0))
        sums -= np.repeat(np.append(0.0, sums[starts[1:] - 1]), sizes)
        pivot = np.minimum.reduceat(np.where(sums >= bar, head, count), starts)
        # Passages without a pivot are done.
        going = pivot < count
        rows = np.repeat(going, sizes)
        passages, terms, ends, head = passages[rows], terms[rows], ends[rows], head[rows]
        pivot, sizes = pivot[going], sizes[going]
        if not len(pivot):
            return found.items()
        starts, here = np.cumsum(sizes) - sizes, np.repeat(pivot, sizes)
        upto = head <= here
        block = pivot // index.block
        most = np.add.reduceat(np.where(upto, index.block_max[terms, np.repeat(block, sizes)], 0.0), starts)
        score = most >= bar
        next_head = np.minimum.reduceat(np.where(upto, count, head), starts)
        skip = np.minimum((block + 1) * index.block, next_head)
        skip = np.maximum(skip, ahead[passages[starts], skip // index.block])
        to = np.repeat(np.where(score, pivot, skip), sizes)
        move = np.flatnonzero(upto)
        at, head[move] = moved(terms[move], ends[move], to[move])
        # The cursors that stand on a scored pivot go one further.
        on = np.repeat(score, sizes)[move] & (head[move] == to[move])
        hit, at = move[on], at[on]
        shares = np.zeros(len(head))
        shares[hit] = index.weights[at]
        shares = np.add.reduceat(shares, starts)
        head[hit] = moved(terms[hit], ends[hit], to[hit] + 1)[1]
        for k in np.flatnonzero(shares >= threshold).tolist():
            best, item = found[int(numbers[passages[starts[k]]])], int(index.owner[pivot[k]])
            best[item] = max(best.get(item, 0.0), float(shares[k]))
    return found.items()


def _matches(index: Index, slots: np.ndarray, texts: pa.Array, threshold: float) -> Iterator[tuple[int, int, float, float, float]]:
    """(row, item, score, question share, answer share) of verified matches."""
    passage, stride = 2 * SEGMENT, SEGMENT
    for begin, _, raw, stops in whole_rows(*utf8(texts)):
        folded, gone = _fold(raw)
        stops = stops - np.searchsorted(gone, stops)
        folded, put = _spread(folded)
        stops = stops + np.searchsorted(put, stops, side="right")
        starts, _, hashes = words_of(folded)
        if not len(hashes):
            continue
        maybe = np.flatnonzero(slots[hashes >> np.uint64(64 - SLOTS)])
        term = np.minimum(np.searchsorted(index.terms, hashes[maybe]), len(index.terms) - 1)
        right = index.terms[term] == hashes[maybe]
        places, term = maybe[right], term[right]
        rows = np.searchsorted(stops, starts, side="right")
        first = np.searchsorted(rows, np.arange(len(stops) + 1))
        # Strides of each text, numbered on; a passage is a stride and the next one of the same text.
        strides = -(-np.diff(first) // stride)
        base = np.append(0, np.cumsum(strides))
        row = rows[places]
        spot = base[row] + (places - first[row]) // stride
        telling = index.essential[term]
        held = np.bincount(spot[telling], index.greatest[term[telling]], base[-1] + 1)
        alive = held[:-1] + np.append(held[1:-1], 0.0) + index.spare >= threshold * (1 - 1e-9)
        # A hit counts for the passage that starts with its stride and for the one before.
        earlier = spot > base[row]
        earlier[earlier] = alive[spot[earlier] - 1]
        key = np.concatenate([spot, spot - 1])[np.concatenate([alive[spot], earlier])] * len(index.terms)
        key = np.unique(key + np.concatenate([term, term])[np.concatenate([alive[spot], earlier])])
        best: dict[tuple[int, int], tuple] = {}
        found_in = _retrieve(index, key // len(index.terms), key % len(index.terms), threshold) if len(key) else ()
        for number, found in found_in:
            row = int(np.searchsorted(base, number, side="right")) - 1
            start = first[row] + (number - base[row]) * stride
            end = min(start + passage, first[row + 1])
            around = hashes[max(first[row], start - index.longest) : min(first[row + 1], end + index.longest)]
            grams = [_grams(around, width) for width in (1, 2, 3)]
            for item, score in found.items():
                shares = [part.share(around, grams) for part in (index.questions[item], index.answers[item])]
                if min(shares) >= BOTH or shares[0] >= ALONE:
                    at = (begin + row, item)
                    best[at] = max(best.get(at, ()), (score, *shares))
        for (row, item), values in best.items():
            yield row, item, *map(float, values)


SCHEMA = "doc_id bigint, item_id bigint, score double, question_share double, answer_share double"


def _pairs(index: Index, threshold: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    slots = index.slots()
    names = ["doc_id", "item_id", "score", "question_share", "answer_share"]
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
    for batch in batches:
        found = [(batch.column("doc_id")[row].as_py(), index.items[item], *rest) for row, item, *rest in _matches(index, slots, batch.column("text"), threshold)]
        columns = zip(*found, strict=True) if found else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)


def _clean(index: Index, threshold: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    slots = index.slots()
    for batch in batches:
        keep = np.ones(batch.num_rows, bool)
        for row, *_ in _matches(index, slots, batch.column("text"), threshold):
            keep[row] = False
        yield batch.filter(pa.array(keep))


def _segment_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shard, term, segments, words): a row per distinct term of a segment, and one without term per item."""
    for batch in batches:
        shards, terms, counts, words = [], [], [], []
        for shard, text in zip(batch.column("shard").to_pylist(), batch.column("text").to_pylist(), strict=True):
            pieces = segments_of(word_hashes(text))
            for piece in pieces:
                own = np.unique(piece).view(np.int64).tolist()
                shards += [shard] * len(own)
                terms += own
                counts += [1] * len(own)
                words += [0] * len(own)
            shards.append(shard)
            terms.append(None)
            counts.append(len(pieces))
            words.append(sum(map(len, pieces)))
        kinds = pa.int64()
        yield pa.RecordBatch.from_arrays([pa.array(c, kinds) for c in (shards, terms, counts, words)], ["shard", "term", "segments", "words"])


def indexes(benchmark: DataFrame, threshold: float = THRESHOLD, shard: int = SHARD) -> Iterator[Index]:
    """Indexes of ``benchmark`` (item_id, text), of about ``shard`` items each; null and empty items are left out.

    Spark counts the terms of all items; the driver reads a shard's items and the counts of its terms.
    """
    items = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("bigint"), "text").distinct()
    shards = max(1, -(-items.count() // shard))
    items = items.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)))
    items = saved(items, "benchmark-items")
    held = items.select("shard", "text").mapInArrow(_segment_terms, "shard bigint, term bigint, segments bigint, words bigint")
    held = held.groupBy("shard", "term").agg(F.sum("segments").alias("segments"), F.sum("words").alias("words"))
    held = saved(held, "benchmark-terms")
    total = held.where("term IS NULL").agg(F.sum("segments").alias("segments"), F.sum("words").alias("words")).first()
    df = held.where("term IS NOT NULL").groupBy("term").agg(F.sum("segments").alias("df"))
    df = saved(held.where("term IS NOT NULL").select("shard", "term").join(df, "term"), "benchmark-frequencies")
    for number in range(shards):
        own = items.where(F.col("shard") == number).orderBy("item_id", "text").collect()
        counted = df.where(F.col("shard") == number).select("term", "df").toPandas()
        terms = counted["term"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(terms)
        statistics = Statistics(total["segments"] or 0, total["words"] or 0, terms[order], counted["df"].to_numpy(np.int64)[order])
        index = build_index([(r["item_id"], r["text"]) for r in own], threshold, statistics)
        if index is not None:
            yield index


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, shard: int = SHARD) -> DataFrame:
    """doc_id, item_id, score, question_share, answer_share of every document that holds an item.

    One row per row of ``docs`` (doc_id, text) and item, with the best passage's figures; rows that
    repeat an id or a text are told on their own, and so are items. Texts are searched whole, however
    long. Null and empty texts hold nothing, null and empty items stand in nothing; an empty table on
    either side gives no rows.
    """
    read = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("bigint"), "text")
    found = read.sparkSession.createDataFrame([], SCHEMA)
    for index in indexes(benchmark, threshold, shard):
        found = found.unionByName(read.mapInArrow(partial(_pairs, index, threshold), SCHEMA))
    return found


def keep_clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` that hold no benchmark item, all columns as they are."""
    for index in indexes(benchmark, threshold):
        docs = docs.mapInArrow(partial(_clean, index, threshold), docs.schema)
    return docs


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
