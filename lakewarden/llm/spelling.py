"""Words and their spelling variants, by blocked Gram matrices.

Words are counted over all texts. Two words are near if one edit, a letter inserted, deleted or
replaced, turns one into the other. Such words have letter counts at a squared distance of at most two,
and squared distances come from products of letter-count matrices: |a - b|^2 = |a|^2 + |b|^2 - 2ab.
Pairs at a distance of at most two are verified letter by letter.

Only blocks that can hold near words meet. Letters are dealt into ``GROUPS`` groups, and a word's cell
says how many letters of each group it has, and so its length: an edit changes one count by one, or one
up and one down, or none. So a word meets its own cell, those of words one letter longer, and those of
its own length with one letter exchanged between groups; each pair of cells meets once. Cells of many
words are dealt into parts of bounded size, each of which meets the words of the neighbouring cells as
a stream of blocks. Spark shuffles words to cells; a task holds one part and one block at a time.

Each word's form is its most frequent near word, if that is far more frequent, and forms are followed
to their roots by doubling steps; a step multiplies the count, so few are needed.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewarden.llm.common import saved, small_batches, table, utf8

#: Least letters and occurrences of a word, and how far more frequent a form is.
LETTERS, OCCURRENCES, RATIO = 6, 5, 5
SLICE_BYTES = 1 << 20
#: Distinct words a task counts before it passes them on.
COUNTED = 200_000
GROUPS = 6
#: Letters are a to z and U+00C0 to U+00FF, one byte each in Latin-1.
ALPHABET = 26 + 64
#: Words of a part, and most cells of more than one part: the driver names these to all tasks.
PART, SPLIT_CELLS = 4096, 50_000
#: Words, and bytes of compared words, that meet a part at a time.
BLOCK, BLOCK_BYTES = 2048, 1 << 22

_LOWER = np.array([b | 0x20 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_LETTER = np.array([97 <= (b | 0x20) <= 122 and b < 128 for b in range(256)])
_LEAD = 0xC3
_keys = np.random.default_rng(199)
_BYTE_KEYS = _keys.integers(1, 2**64, 256, np.uint64, endpoint=False) | np.uint64(1)
_PLACE_KEYS = _keys.integers(1, 2**64, 4096, np.uint64, endpoint=False) | np.uint64(1)


# Counting


def _shift_tables(longest: int) -> np.ndarray:
    """[n, k, b]: what byte ``b`` at place ``k`` of a CRC-32 becomes when ``n`` bytes follow."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1).astype(np.uint32)
    out = np.zeros((longest + 1, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32)[:, None])
    for n in range(1, longest + 1):
        out[n] = (out[n - 1] >> 8) ^ step[out[n - 1] & 255]
    return out


SHIFTS = _shift_tables(64)


def crc_after(prefix: np.ndarray, lengths: np.ndarray, own: np.ndarray) -> np.ndarray:
    """CRC-32 of prefix and word together, from both CRCs and the words' lengths in bytes, at most 64."""
    out = own.astype(np.uint32)
    for k in range(4):
        out = out ^ SHIFTS[lengths, k, (prefix >> np.uint32(8 * k)) & np.uint32(255)]
    return out


def _in_run(data: np.ndarray) -> np.ndarray:
    """Whether each byte belongs to a letter of a word; ``data`` begins with a whole character."""
    lead = data == _LEAD
    inside = _LETTER[data] | lead
    inside[1:] |= lead[:-1]
    return inside


def _blocks(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, end row, place of each row's end) of bounded blocks; no run of letters is cut.

    A block holds whole texts, or a part of a single long one. Only a longer run of letters makes a
    block longer.
    """
    row, rows = 0, len(offsets) - 1
    while row < rows:
        low = int(offsets[row])
        end = max(row + 1, int(np.searchsorted(offsets, low + SLICE_BYTES, side="right")) - 1)
        high = int(offsets[end])
        while high - low > SLICE_BYTES:
            cut = low + SLICE_BYTES
            while cut < high:
                out = np.flatnonzero(~_in_run(data[cut - 1 : cut + SLICE_BYTES])[1:])
                if len(out):
                    cut += int(out[0])
                    break
                cut += SLICE_BYTES
            if cut >= high:
                break
            yield low, cut, row, np.array([cut])
            low = cut
        yield low, high, row, offsets[row + 1 : end + 1]
        row = end


def _runs(data: np.ndarray, low: int, high: int, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs in a block; none reaches from one text into the next."""
    inside = _in_run(data[low:high])
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    seams = ends[(ends > low) & (ends < high)] - low
    first[seams] |= inside[seams]
    last[seams - 1] |= inside[seams - 1]
    return low + np.flatnonzero(first), low + np.flatnonzero(last) + 1


def word_counts(doc_ids: list, texts: pa.Array, divisor: int = 199) -> Iterator[dict[bytes, int]]:
    """Counts of words of at least ``LETTERS`` letters, as UTF-8, block by block.

    Runs whose hash with the document's id is divisible by ``divisor`` lose one letter first.
    """
    data, offsets = utf8(texts)
    data = _LOWER[data]
    prefixes = [b"%d:" % n if n is not None else b":" for n in doc_ids]
    crcs = np.array([zlib.crc32(p) for p in prefixes], np.uint32)
    for low, high, row, row_ends in _blocks(data, offsets):
        starts, ends = _runs(data, low, high, row_ends)
        leads = np.concatenate([[0], np.cumsum(data[low:high] == _LEAD)])
        letters = ends - starts - (leads[ends - low] - leads[starts - low])
        long_enough = letters >= LETTERS
        starts, ends = starts[long_enough], ends[long_enough]
        if not len(starts):
            continue
        lengths = ends - starts
        rows = row + np.searchsorted(row_ends, starts, side="right")
        # One hash per run finds the distinct ones of this block.
        first = np.cumsum(lengths) - lengths
        place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
        sums = np.add.reduceat(_BYTE_KEYS[data[np.repeat(starts, lengths) + place]] * _PLACE_KEYS[place & 4095], first)
        _, sample, kind, number = np.unique(sums ^ lengths.astype(np.uint64), return_index=True, return_inverse=True, return_counts=True)
        words = [data[a:b].tobytes() for a, b in zip(starts[sample].tolist(), ends[sample].tolist(), strict=True)]
        own = np.array([zlib.crc32(w) for w in words], np.uint32)
        h = crc_after(crcs[rows], np.minimum(lengths, 64), own[kind])
        for i in np.flatnonzero(lengths > 64).tolist():
            h[i] = zlib.crc32(words[kind[i]], int(crcs[rows[i]]))
        counts = dict(zip(words, number.tolist(), strict=True))
        for i in np.flatnonzero(h % divisor == 0).tolist():
            word = words[kind[i]]
            counts[word] -= 1
            text = word.decode()
            gone = int(h[i]) % len(text)
            if len(text) > LETTERS:
                changed = (text[:gone] + text[gone + 1 :]).encode()
                counts[changed] = counts.get(changed, 0) + 1
        yield counts


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[bytes, int] = {}

    def out() -> pa.RecordBatch:
        words = pa.array(list(held), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(held.values()), pa.int64())], ["word", "n"])

    for batch in batches:
        for counts in word_counts(batch.column("doc_id").to_pylist(), batch.column("text")):
            for word, n in counts.items():
                held[word] = held.get(word, 0) + n
            if len(held) >= COUNTED:
                yield out()
                held = {}
    if held:
        yield out()


def vocabulary(docs: DataFrame) -> DataFrame:
    """word, n: the words of (doc_id, text) and how often they occur; null texts have none."""
    read = docs.select(F.col("doc_id").cast("bigint"), "text")
    counts = read.mapInArrow(_counted, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    with small_batches(docs.sparkSession):
        return saved(counts.where(F.col("n") >= OCCURRENCES), "vocabulary")


# Cells


def _letters(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of Latin-1 words, one after the other, from 0, and the words' lengths."""
    raw = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
    return np.where(raw < 128, raw - 97, raw - 192 + 26), np.array([len(w) for w in words], np.int64)


def cells_of(words: list[bytes]) -> np.ndarray:
    """The cell of each word: its letter counts by group, as the digits of one number."""
    letters, lengths = _letters(words)
    weights = np.int64(256) ** (letters % GROUPS)
    return np.add.reduceat(weights, np.cumsum(lengths) - lengths)


def _neighbours() -> np.ndarray:
    """What to add to a cell for the other cells it meets: one letter more, or one exchanged."""
    unit = [256**g for g in range(GROUPS)]
    return np.array([*unit, *[unit[g] - unit[h] for g in range(GROUPS) for h in range(g)]], np.int64)


def _dealt(parts: dict[int, int], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each word at its own part and at all parts of cells it meets."""
    steps = _neighbours()
    for batch in batches:
        words = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
        if not words:
            continue
        cells = cells_of(words)
        target = np.concatenate([cells[:, None], cells[:, None] + steps], axis=1)
        index, cell, part, visitor = [], [], [], []
        for i in range(len(words)):
            for k, c in enumerate(target[i].tolist()):
                split = parts.get(c, 1)
                mine = zlib.crc32(words[i]) % split if k == 0 else -1
                for p in range(max(mine, 0), split):
                    index.append(i)
                    cell.append(c)
                    part.append(p)
                    visitor.append(p != mine)
        taken = batch.take(pa.array(index))
        arrays = [pa.array(cell, pa.int64()), pa.array(part, pa.int32()), pa.array(visitor), *taken.columns]
        yield pa.RecordBatch.from_arrays(arrays, ["cell", "part", "visitor", *taken.schema.names])


# Pairs


def close_pairs(a: list[bytes], b: list[bytes] | None) -> tuple[np.ndarray, np.ndarray]:
    """Indices of pairs at a squared distance of letter counts of at most two; without ``b``, pairs i < j within ``a``."""
    other = a if b is None else b

    def counts(words: list[bytes]) -> np.ndarray:
        letters, lengths = _letters(words)
        places = np.repeat(np.arange(len(words)), lengths) * ALPHABET + letters
        return np.bincount(places, minlength=len(words) * ALPHABET).reshape(len(words), ALPHABET)

    left, right = counts(a), counts(other)
    # Sums below 2**24 are exact in single precision.
    kind = np.float32 if max(left.sum(1).max(), right.sum(1).max()) < 4096 else np.float64
    used = left.any(0)
    norms = (left**2).sum(1).astype(kind), (right**2).sum(1).astype(kind)
    left, right = left[:, used].astype(kind), right[:, used].astype(kind)
    rows, columns = [], []
    for at in range(0, len(left), 512):
        # Half the squared distance is at most one where the product is large enough.
        gram = left[at : at + 512] @ right.T
        gram -= 0.5 * norms[0][at : at + 512, None]
        i, j = np.nonzero(gram >= 0.5 * norms[1][None, :] - 1)
        rows.append(i + at)
        columns.append(j)
    i, j = np.concatenate(rows), np.concatenate(columns)
    keep = i < j if b is None else slice(None)
    return i[keep], j[keep]


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether words (rows of bytes, zeros behind) differ by exactly one edit."""
    size_a, size_b = (a != 0).sum(1), (b != 0).sum(1)
    swap = size_a > size_b
    short, long_ = np.where(swap[:, None], b, a), np.where(swap[:, None], a, b)
    gap = np.abs(size_a - size_b)
    replaced = (gap == 0) & ((a != b).sum(1) == 1)
    same = short == long_
    shifted = np.zeros_like(same)
    shifted[:, :-1] = short[:, :-1] == long_[:, 1:]
    shifted[:, -1] = short[:, -1] == 0
    width = same.shape[1]
    head = np.where(same.all(1), width, same.argmin(1))
    tail = np.where(shifted.all(1), width, shifted[:, ::-1].argmin(1))
    return replaced | ((gap == 1) & (head + tail >= width))


NEAR = "word string, n_near bigint, best_n bigint, best string"


def _best(words: np.ndarray, near: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """For each word of the pairs: how many near words, and the most frequent of them, of equals the first."""
    order = np.lexsort((near, -n, words))
    words, near, n = words[order], near[order], n[order]
    first = np.flatnonzero(np.append(True, words[1:] != words[:-1]))
    number = np.diff(np.append(first, len(words)))

    def text(column: np.ndarray) -> pa.Array:
        return pa.array([w.decode("latin-1") for w in column.tolist()], pa.string())

    return pa.RecordBatch.from_arrays([text(words[first]), pa.array(number), pa.array(n[first]), text(near[first])], ["word", "n_near", "best_n", "best"])


def _verified(a: tuple[list, list], b: tuple[list, list] | None) -> Iterator[pa.RecordBatch]:
    """Near pairs of two blocks of (words, counts), or within one, told to both words."""
    other = a if b is None else b
    i, j = close_pairs(a[0], None if b is None else b[0])
    if not len(i):
        return
    width = max(map(len, a[0] + other[0]))
    step = max(1, BLOCK_BYTES // width)
    counts = np.array(a[1], np.int64), np.array(other[1], np.int64)
    for at in range(0, len(i), step):
        left = np.array([a[0][k] for k in i[at : at + step].tolist()], f"S{width}")
        right = np.array([other[0][k] for k in j[at : at + step].tolist()], f"S{width}")
        good = one_edit(left.view(np.uint8).reshape(-1, width), right.view(np.uint8).reshape(-1, width))
        if good.any():
            left, right = left[good], right[good]
            n_left, n_right = counts[0][i[at : at + step][good]], counts[1][j[at : at + step][good]]
            yield _best(np.concatenate([left, right]), np.concatenate([right, left]), np.concatenate([n_right, n_left]))


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of each part, from rows sorted by cell and part, its own words first."""
    key = None
    own: tuple[list, list] = ([], [])
    block: tuple[list, list] = ([], [])
    size = 0
    within = False

    def meet() -> Iterator[pa.RecordBatch]:
        if own[0] and within:
            yield from _verified(own, None)
        if own[0] and block[0]:
            yield from _verified(own, block)

    for batch in batches:
        for cell, part, visitor, word, n in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if (cell, part) != key:
                yield from meet()
                key, own, block, size, within = (cell, part), ([], []), ([], []), 0, True
            if not visitor:
                side = own
            elif own[0]:
                side = block
            else:
                # A cell without words of its own meets nobody.
                continue
            coded = word.encode("latin-1")
            side[0].append(coded)
            side[1].append(n)
            size += len(coded) if visitor else 0
            if len(block[0]) >= BLOCK or size >= BLOCK_BYTES:
                yield from meet()
                block, size, within = ([], []), 0, False
    yield from meet()


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near, form, form_n for each word of the stored table (word, n) that has near words.

    ``form`` is the near word of largest ``n``, of equals the first in code-point order, whatever its n.
    """
    spark = words.sparkSession
    size = words.count()
    with_cells = words.mapInArrow(_celled, "cell bigint")
    limit = max(PART, -(-size // SPLIT_CELLS))
    # At most SPLIT_CELLS cells can hold more words than the limit.
    large = with_cells.groupBy("cell").count().where(F.col("count") > limit).collect()
    parts = {r["cell"]: -(-r["count"] // limit) for r in large}
    dealt = words.mapInArrow(partial(_dealt, parts), "cell bigint, part int, visitor boolean, word string, n bigint")
    number = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PART))
    ready = dealt.repartition(number, "cell", "part").sortWithinPartitions("cell", "part", "visitor")
    met = ready.mapInArrow(_met, NEAR)
    # Minima of (-n, word): the most frequent, of equals the first.
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    found = met.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return found.select("word", "n_near", F.col("best.word").alias("form"), (-F.col("best.n")).alias("form_n"))


def _celled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
        if words:
            yield pa.RecordBatch.from_arrays([pa.array(cells_of(words))], ["cell"])


def _roots(forms: DataFrame, largest: int) -> DataFrame:
    """word, root for each word of the stored table (word, form): forms followed to the last.

    Each round doubles the steps taken. A form is ``RATIO`` times as frequent, so the largest count
    bounds the steps.
    """
    steps = max(1, math.ceil(math.log(max(largest / OCCURRENCES, RATIO), RATIO)))
    roots = forms.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        on = roots.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        further = roots.join(on, F.col("root") == F.col("_at"), "left")
        roots = saved(further.select("word", F.coalesce("_next", "root").alias("root")), "roots")
    return roots


def spelling_variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of (doc_id, text).

    Words are runs of a to z and U+00C0 to U+00FF, after lower-casing A-Z, of at least ``LETTERS``
    letters, that occur ``OCCURRENCES`` times or more over all texts; some runs lose a letter first, by
    a hash of id and run. A null id counts as an empty one. ``n_near`` is the number of words one edit
    away. ``form`` is the most frequent of them, of equals the first in code-point order, if it is
    ``RATIO`` times as frequent as the word, else null; ``root`` is where forms lead, the word itself
    if it has none. Repeated rows count again. Null and empty texts have no words; an empty table gives
    no rows.
    """
    words = vocabulary(docs)
    largest = words.agg(F.max("n")).first()[0] or 0
    near = saved(near_words(words), "near-words")
    joined = words.join(near, "word", "left")
    far = F.col("form_n") >= RATIO * F.col("n")
    named = joined.select(
        "word",
        F.when(far, F.col("form")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(far, F.col("form_n")).alias("form_n"),
    )
    named = saved(named, "word-forms")
    roots = _roots(named.where(F.col("form").isNotNull()), largest)
    out = named.join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents."""
    return spelling_variants(table(spark, sf_dir, "documents"))


OP13_SQL = """
WITH RECURSIVE
crc_table AS (
    SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
),
found AS (
    SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents
),
runs AS (
    SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
    FROM found GROUP BY ALL
),
hashed AS (
    SELECT run, n, xor(list_reduce(
        list_concat([CAST(4294967295 AS BIGINT)], list_transform(
            flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
                lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)] ELSE [195, unicode(x) - 64] END)),
            lambda b: CAST(b AS BIGINT))),
        lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS BIGINT) + 1])), 4294967295) AS h
    FROM runs, crc_table
    WHERE length(run) >= 6
),
words AS (
    SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
           CAST(sum(n) AS BIGINT) AS n
    FROM hashed GROUP BY 1
    HAVING length(word) >= 6 AND sum(n) >= 5
),
less AS (
    SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
),
near AS (
    SELECT a.word, b.word AS other, b.n FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION
    SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
    UNION
    SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word
),
best AS (
    SELECT word, other, n AS other_n, count(*) OVER (PARTITION BY word) AS n_near
    FROM near QUALIFY row_number() OVER (PARTITION BY word ORDER BY n DESC, other) = 1
),
named AS (
    SELECT word, CASE WHEN other_n >= 5 * words.n THEN other END AS form, words.n, coalesce(n_near, 0) AS n_near,
           CASE WHEN other_n >= 5 * words.n THEN other_n END AS form_n
    FROM words LEFT JOIN best USING (word)
),
chain AS (
    SELECT word, form AS root FROM named WHERE form IS NOT NULL
    UNION ALL
    SELECT chain.word, named.form FROM chain JOIN named ON chain.root = named.word WHERE named.form IS NOT NULL
),
roots AS (
    SELECT chain.word, chain.root FROM chain JOIN named ON chain.root = named.word WHERE named.form IS NULL
)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM named LEFT JOIN roots USING (word)
"""
