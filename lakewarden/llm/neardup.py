"""Near duplicates by SetSketch registers.

A sketch of a shingle set has ``REGISTERS`` registers. Each shingle drops points on a line of
exponential gaps, each point on one register; a register keeps the smallest point it gets, rounded
down to a power of ``BASE``. Sketches of a union are the maxima of the registers, and equal registers
tell similar sets.

1. Every text is sketched. Texts with the same set are one class, named by its smallest id.
2. Bands of registers put classes into buckets. In each bucket one class, the one that shares most,
   is compared with the others: by the joint likelihood of the two sketches first, then on their full
   sets.
3. Links make components. Where a bucket still holds several, its classes are joined by the prefixes
   of their sets, and pairs of different components that may be linked are compared on their full
   sets. Pairs of a component that is connected already are never compared, so a group of copies
   costs as many comparisons as it has members.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakewarden.llm.common import mix, saved, small_batches, table
from lakewarden.llm.components import connected
from lakewarden.llm.shingles import shingle_sets
from lakewarden.operators.matching import narrowed

REGISTERS = 120
BASE = 1.001
#: Points are dropped up to where a register stays empty once in some thousand sets.
REACH = np.log(REGISTERS) + 8
#: Registers count up from here, so that sets of any size fit 16 bits.
LARGEST_POINT = 40.0
#: Smallest similarity that is estimated.
LEAST_ESTIMATE = 0.2
#: Similarity in hundredths from which two texts are linked, unless a caller names another.
LINKED = 85
#: Greatest chance that two texts at the threshold share no band, and that their estimate hides a link.
MISSED, HIDDEN = 1e-6, 1e-7
#: Sizes of one class of sizes differ by less than this factor.
SIZES = 1.08


def slack_of(linked: int) -> float:
    """How far below the threshold an estimate is still checked.

    The number of equal registers of two texts at the threshold is binomial; it falls short by more
    than the slack at most ``HIDDEN`` of the time. Known sizes make the joint estimate narrower still.
    """
    share, chance, equal = linked / 100, 0.0, -1
    while True:
        equal += 1
        chance += math.comb(REGISTERS, equal) * share**equal * (1 - share) ** (REGISTERS - equal)
        if chance > HIDDEN:
            return share - (equal - 1) / REGISTERS


def bands_of(linked: int) -> tuple[int, int]:
    """Number of bands and registers of each: the longest bands that miss a pair at ``linked`` at most ``MISSED`` of the time."""
    for rows in range(REGISTERS, 1, -1):
        if REGISTERS % rows == 0 and (1 - (linked / 100) ** rows) ** (REGISTERS // rows) <= MISSED:
            return REGISTERS // rows, rows
    return REGISTERS, 1


def registers_of(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One row of registers per set; an empty set has all zeros."""
    owner = np.repeat(np.arange(len(counts)), counts)
    limit = REACH / np.maximum(counts, 1)
    least = np.full(len(counts) * REGISTERS, np.inf)
    point = np.zeros(len(hashes))
    step = 0
    while len(hashes):
        step += 1
        drawn = mix(hashes + np.uint64(step * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        point = point - np.log(((drawn >> np.uint64(16)).astype(np.float64) + 1) / 2.0**48) / REGISTERS
        alive = point < limit[owner]
        hashes, owner, point, drawn = hashes[alive], owner[alive], point[alive], drawn[alive]
        register = ((drawn & np.uint64(0xFFFF)) * np.uint64(REGISTERS)) >> np.uint64(16)
        np.minimum.at(least, owner * REGISTERS + register.astype(np.int64), point)
    level = 1 + np.floor(np.log(LARGEST_POINT / np.minimum(least, 2 * LARGEST_POINT)) / np.log(BASE))
    return np.clip(level, 0, 32767).astype(np.int16).reshape(len(counts), REGISTERS)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The registers of the union of two sets."""
    return np.maximum(a, b)


def joint_estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of pairs of sketches of sets of known size.

    The counts of registers that are larger, smaller and equal decide; values below ``LEAST_ESTIMATE``
    come out as that.
    """
    more, less = (a > b).sum(1), (a < b).sum(1)
    u, v = size_a / (size_a + size_b), size_b / (size_a + size_b)
    grid = np.linspace(LEAST_ESTIMATE, 1.0, 201)

    def chance(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 1e-9, 1) * (BASE - 1) / BASE) / np.log(BASE)

    up, down = chance(u[:, None] - v[:, None] * grid), chance(v[:, None] - u[:, None] * grid)
    same = np.log(np.clip(1 - up - down, 1e-9, 1))
    likelihood = more[:, None] * np.log(up) + less[:, None] * np.log(down) + (REGISTERS - more - less)[:, None] * same
    likelihood[grid > np.minimum(u / v, v / u)[:, None] + 1e-9] = -np.inf
    return grid[likelihood.argmax(1)]


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        row = 0
        for hashes, counts in shingle_sets(batch.column("text")):
            rows = len(counts)
            starts = np.cumsum(counts) - counts
            keys = []
            for salt in (0x51, 0xA7):
                sums = np.append(np.zeros(1, np.uint64), np.cumsum(mix(hashes ^ np.uint64(salt)), dtype=np.uint64))
                keys.append((sums[starts + counts] - sums[starts]).astype(np.int64))
            registers = registers_of(hashes, counts).reshape(-1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(row, rows),
                    pa.array(counts, pa.int64()),
                    pa.array(keys[0]),
                    pa.array(keys[1]),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, rows + 1) * REGISTERS, pa.int32()), pa.array(registers)),
                ],
                ["doc_id", "n_shingles", "k1", "k2", "registers"],
            )
            row += rows


SKETCH = "doc_id bigint, n_shingles bigint, k1 bigint, k2 bigint, registers array<smallint>"


def _likely(linked: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose estimate does not rule out a link."""
    for batch in batches:
        if batch.num_rows:
            a, b = (batch.column(c).flatten().to_numpy().reshape(-1, REGISTERS) for c in ("ra", "rb"))
            na, nb = (batch.column(c).to_numpy().astype(float) for c in ("na", "nb"))
            near = joint_estimate(a, b, na, nb) >= linked / 100 - slack_of(linked)
            yield batch.select(["a", "b"]).filter(pa.array(near))


def _verified(linked: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs linked on their full shingle sets."""
    for batch in batches:
        sides = []
        for name in ("ta", "tb"):
            own = []
            for hashes, counts in shingle_sets(_texts(batch.column(name))):
                own += np.split(hashes, np.cumsum(counts)[:-1])
            sides.append(own)
        near = []
        for x, y in zip(*sides, strict=True):
            both = len(np.intersect1d(x, y, assume_unique=True))
            near.append(both > 0 and 100 * both >= linked * (len(x) + len(y) - both))
        yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per shingle of each text."""
    for batch in batches:
        ids, own = batch.column("class_id").to_numpy(), batch.column("own").to_numpy()
        row = 0
        for hashes, counts in shingle_sets(_texts(batch.column("packed"))):
            rows = np.repeat(np.arange(row, row + len(counts)), counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[rows]), pa.array(own[rows]), pa.array(np.repeat(counts, counts)), pa.array(hashes.view(np.int64))],
                ["class_id", "own", "n", "shingle"],
            )
            row += len(counts)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed for the shuffle."""
    packer = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        texts = [packer.compress((t.as_py() or "").encode()) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("class_id"), pa.array(texts, pa.binary())], ["class_id", "packed"])


def _texts(packed: pa.Array) -> pa.Array:
    opener = zstandard.ZstdDecompressor()
    return pa.array([opener.decompress(p.as_buffer()).decode() for p in packed], pa.string())


def _side(df: DataFrame, key: str, *columns: tuple[str, str]) -> DataFrame:
    return df.select(F.col("class_id").alias(key), *[F.col(old).alias(new) for old, new in columns])


def _likely_pairs(pairs: DataFrame, reps: DataFrame, linked: int) -> DataFrame:
    """The pairs (a, b) of classes that sizes and sketches do not rule out."""
    sized = pairs.join(_side(reps, "a", ("n_shingles", "na"), ("registers", "ra")), "a")
    sized = sized.join(_side(reps, "b", ("n_shingles", "nb"), ("registers", "rb")), "b")
    sized = sized.where(100 * F.least("na", "nb") >= linked * F.greatest("na", "nb"))
    return sized.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(partial(_likely, linked), "a bigint, b bigint").distinct()


def _links(pairs: DataFrame, texts: DataFrame, linked: int) -> DataFrame:
    """The pairs (a, b) of classes that are linked, by their full texts."""
    both = pairs.join(_side(texts, "a", ("packed", "ta")), "a").join(_side(texts, "b", ("packed", "tb")), "b")
    checked = both.select("a", "b", "ta", "tb").mapInArrow(partial(_verified, linked), "a bigint, b bigint")
    with small_batches(pairs.sparkSession):
        return saved(checked, "verified-links")


def near_duplicates(docs: DataFrame, linked: int = LINKED) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Texts are linked whose sets have a Jaccard similarity of ``linked`` hundredths or more.
    ``component_id`` is the smallest id of the documents reachable over links, the document itself
    included; ``kept`` marks the document that names its component. Texts that are null, empty or
    white space have no shingles and no links. Ids are taken to be unique; rows that repeat an id and
    text are members of the same class. Rows without an id have no component, link with nothing and
    are kept.
    """
    spark = docs.sparkSession
    read = docs.select(F.col("doc_id").cast("bigint"), "text")
    with small_batches(spark, 2000):
        sketches = saved(read.mapInArrow(_sketches, SKETCH), "sketches")
    full = sketches.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = saved(full.groupBy("k1", "k2").agg(F.min("doc_id").alias("class_id")), "classes")
    same = (full["k1"] == classes["k1"]) & (full["k2"] == classes["k2"]) & (full["doc_id"] == classes["class_id"])
    reps = saved(full.join(classes, same, "left_semi").withColumnRenamed("doc_id", "class_id"), "representatives")
    number, rows = bands_of(linked)
    band = F.transform(
        F.sequence(F.lit(0), F.lit(number - 1)),
        lambda b: F.xxhash64(b, F.slice("registers", b * rows + 1, F.lit(rows))),
    )
    bands = reps.select("class_id", F.explode(band).alias("band"))
    sizes = bands.groupBy("band").agg(F.count("*").alias("size")).where(F.col("size") > 1)
    buckets = saved(bands.join(sizes, "band"), "buckets")
    # The class that shares most is the likeliest to link with the others.
    fame = buckets.groupBy("class_id").agg(F.sum("size").alias("fame"))
    famed = buckets.select("band", "class_id").join(fame, "class_id")
    ahead = F.max(F.struct("fame", (-F.col("class_id")).alias("id")))
    pivots = saved(famed.groupBy("band").agg(ahead.alias("top")).select("band", (-F.col("top.id")).alias("pivot")), "pivots")
    star = buckets.join(pivots, "band").where(F.col("class_id") != F.col("pivot"))
    star = saved(star.select("band", "class_id", "pivot"), "stars")
    # Only classes that share a band travel: their texts, and their registers once more.
    ids = saved(fame.select("class_id"), "candidates")
    packed = narrowed(read.withColumnRenamed("doc_id", "class_id"), "class_id", ids).mapInArrow(_packed, "class_id bigint, packed binary")
    texts = saved(packed.join(ids, "class_id", "left_semi"), "candidate-texts")
    pairs = star.select(F.least("pivot", "class_id").alias("a"), F.greatest("pivot", "class_id").alias("b")).distinct()
    links = _links(_likely_pairs(pairs, narrowed(reps, "class_id", ids), linked), texts, linked)
    components = saved(connected(links), "components")
    more = _links(_open_pairs(star, components, texts, linked), texts, linked)
    if not more.isEmpty():
        components = saved(connected(links.unionByName(more)), "components")
    named = classes.join(components, classes["class_id"] == components["node"], "left")
    named = saved(named.select("k1", "k2", F.coalesce("component", "class_id").alias("component")), "named-classes")
    known = sketches.drop("registers").withColumn("_own", F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("k1")))
    named = named.select(F.col("k1").alias("_own"), F.col("k2").alias("_k2"), "component")
    joined = known.join(named, (known["_own"] == named["_own"]) & (known["k2"] == named["_k2"]), "left")
    component = F.coalesce("component", "doc_id").alias("component_id")
    return joined.select("doc_id", "n_shingles", component, F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _open_pairs(star: DataFrame, components: DataFrame, texts: DataFrame, linked: int) -> DataFrame:
    """Pairs (a, b) of classes of different components that may be linked, though no star compared them.

    The classes outside the component of their bucket's pivot, and those they share a bucket with, are
    joined by prefix: with each set's shingles in order of their frequency among these classes, two
    linked sets share one of the first, and what either has left from there on bounds their overlap.
    Shingles of one class only link nothing, and they come first; so classes with many of their own
    drop out at once, however many there are.

    A shingle joins the smaller set with sets of the classes of sizes that what it has left allows. Of
    texts from one template whose similarity stays below the threshold, no shared shingle is early
    enough to join them, however many they are.
    """

    def named(df: DataFrame, key: str, name: str) -> DataFrame:
        own = components.select(F.col("node").alias(key), F.col("component").alias("_component"))
        return df.join(own, key, "left").withColumn(name, F.coalesce("_component", key)).drop("_component")

    state = named(named(star, "class_id", "own"), "pivot", "main").withColumn("apart", (F.col("own") != F.col("main")).cast("int"))
    state = saved(state.select("band", "class_id", "own", "apart"), "star-components")
    # A single class outside has met the pivot, and the others of the bucket may still be its links.
    open_ = state.groupBy("band").agg(F.max("apart").alias("apart"), F.count("*").alias("others"))
    open_ = open_.where((F.col("apart") == 1) & (F.col("others") > 1)).select("band")
    members = saved(state.join(open_, "band").select("class_id", "own").distinct(), "open-classes")
    held = texts.join(members, "class_id").select("class_id", "own", "packed")
    shingles = held.mapInArrow(_exploded, "class_id bigint, own bigint, n bigint, shingle bigint")
    common = shingles.groupBy("shingle").agg(F.count("*").alias("df"), (F.min("own") != F.max("own")).alias("crosses"))
    common = saved(common.where(F.col("df") > 1), "shared-shingles")
    shared = shingles.join(common, "shingle")
    mine = Window.partitionBy("class_id")
    own_first = F.col("n") - F.count("*").over(mine)
    place = own_first + F.row_number().over(mine.orderBy("df", "shingle")) - 1
    left = shared.select("class_id", "own", "n", "shingle", "crosses", (F.col("n") - place).alias("left"))
    # A shingle of one component only joins nothing; it has kept its place in the order.
    prefix = left.where((100 * F.col("left") >= linked * F.col("n")) & F.col("crosses")).drop("crosses")
    prefix = saved(prefix, "prefixes")

    def sizes(n: Column) -> Column:
        return F.floor(F.log(n.cast("double")) / math.log(SIZES)).cast("int")

    # Sizes that a larger set may have, so that the overlap can still suffice.
    most = F.floor((100 + linked) * F.col("left") / linked - F.col("n"))
    most = F.least(most, F.floor(100 * F.col("n") / linked))
    smaller = prefix.withColumn("most", most).where(F.col("most") >= F.col("n"))
    smaller = smaller.withColumn("size", F.explode(F.sequence(sizes(F.col("n")), sizes(F.col("most")))))
    larger = prefix.withColumn("size", sizes(F.col("n")))
    return _across(smaller, larger, linked)


def _across(smaller: DataFrame, larger: DataFrame, linked: int) -> DataFrame:
    """Pairs (a, b) of different components that meet at a shingle and class of sizes, and whose overlap can suffice.

    Members of one component are many at a key, but not to be compared. So the larger sets of the
    component that has most of them at a key are met by those of other components only; what else meets
    within a component is no more than what meets across.
    """
    key = ["shingle", "size"]
    counts = larger.groupBy(*key, "own").agg(F.count("*").alias("count"))
    main = counts.groupBy(*key).agg(F.max(F.struct("count", "own"))["own"].alias("main"))
    main = saved(main, "main-components")

    def side(df: DataFrame, end: str, kind: Column) -> DataFrame:
        placed = df.join(main, key).withColumn("kind", kind)
        return placed.select(*key, "kind", *[F.col(c).alias(c + end) for c in ("class_id", "own", "n", "left")])

    inside = F.col("own") == F.col("main")
    a = side(smaller, "a", F.explode(F.when(inside, F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))))
    b = side(larger, "b", inside)
    needed = linked * (F.col("na") + F.col("nb"))
    enough = (100 + linked) * F.least("lefta", "leftb") >= needed
    ordered = (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("class_ida") < F.col("class_idb")))
    met = a.join(b, [*key, "kind"]).where(ordered & (F.col("owna") != F.col("ownb")) & enough)
    return met.select(F.least("class_ida", "class_idb").alias("a"), F.greatest("class_ida", "class_idb").alias("b")).distinct()


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents at a similarity of 0.85."""
    return near_duplicates(table(spark, sf_dir, "documents"))


OP7_SQL = r"""
WITH RECURSIVE
texts AS (
    SELECT row_number() OVER () AS row, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
words AS (
    SELECT row, doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i, len(w) AS words FROM texts
),
runs AS (
    SELECT row, doc_id, words, i, string_agg(word, ' ') OVER (PARTITION BY row ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS shingle
    FROM words
),
-- The whole text, where it has fewer words.
held AS (
    SELECT DISTINCT row, doc_id, shingle FROM runs WHERE i = 1 OR i + 4 <= words
),
sized AS (
    SELECT texts.row, texts.doc_id, count(shingle) AS n FROM texts LEFT JOIN held USING (row) GROUP BY ALL
),
shared AS (
    SELECT a.row AS a, b.row AS b, count(*) AS both_have FROM held a JOIN held b USING (shingle)
    WHERE a.row <> b.row AND a.doc_id IS NOT NULL AND b.doc_id IS NOT NULL GROUP BY 1, 2
),
links AS (
    SELECT a, b FROM shared JOIN sized x ON x.row = a JOIN sized y ON y.row = b
    WHERE 100 * both_have >= 85 * (x.n + y.n - both_have)
),
reached AS (
    SELECT a AS row, b AS other FROM links
    UNION
    SELECT reached.row, links.b FROM reached JOIN links ON reached.other = links.a
),
least AS (
    SELECT reached.row, min(sized.doc_id) AS least FROM reached JOIN sized ON sized.row = reached.other GROUP BY 1
)
SELECT doc_id, n AS n_shingles, least(doc_id, least) AS component_id, coalesce(doc_id = least(doc_id, least), TRUE) AS kept
FROM sized LEFT JOIN least USING (row)
"""
