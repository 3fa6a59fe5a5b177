"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

A lexicon is learned first: words and beginnings of words that occur in more toxic texts of the sample
than in others, with their log-odds. The features of a text are densities of lexicon words, how close
they stand to the second person, and rates of capitals, punctuation and obfuscation. Letters written
as digits or signs inside a word are read as letters, so disguised words are found too.

A training text's own contribution is taken out of the lexicon's counts before its features are
computed; else its features would know its label. Out-of-fold margins fit the isotonic calibration.

Texts are read whole, in slices of bytes; one automaton finds all lexicon words in one pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewarden.llm.boosting import Trees, fit_trees, isotonic
from lakewarden.llm.common import FOLD, SPACE, remainder, sample_key, saved, sigmoid, slices, table, utf8

#: Bytes of a word's beginning that may stand for the word.
SHORTEST, LONGEST = 4, 12
NEAR = 40
SECOND_PERSON = (
    "you your yours yourself youre du dich dir dein deine deinen ihr euch vous votre vos toi usted ustedes vosotros".split()
)
#: Signs that stand for letters inside words.
LEET = np.zeros(256, np.uint8)
for sign, letter in zip("013457@$!", "oieastasi", strict=True):
    LEET[ord(sign)] = ord(letter)
PUNCTUATION = np.array([33 <= b <= 47 or 58 <= b <= 64 or 91 <= b <= 96 or 123 <= b <= 126 for b in range(256)])
CAPITAL = np.array([65 <= b <= 90 for b in range(256)])

FEATURES = (
    "weight_density hit_density best second_best distinct near_second_person second_person_density capitals "
    "shouted punctuation exclamations obfuscation disguised_hits log_words"
).split()


def _fold(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case text with signs inside words read as letters, and where these signs are."""
    folded = FOLD[raw]
    after_c3 = np.append(False, raw[:-1] == 0xC3)
    capital = after_c3 & (raw >= 0x80) & (raw <= 0x9E) & (raw != 0x97)
    folded[capital] += 0x20
    letter = folded != SPACE
    inside = (LEET[raw] > 0) & np.append(False, letter[:-1]) & np.append(letter[1:], False)
    folded[inside] = LEET[raw][inside]
    return folded, inside


@dataclass
class Lexicon:
    """Weights by entry: as learned, and with a clean or a toxic text taken out of the counts."""

    entries: list[bytes]
    weights: np.ndarray

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for number, entry in enumerate(self.entries):
            found.add_word((b" " + entry).decode("latin-1"), (number, len(entry)))
        for word in SECOND_PERSON:
            found.add_word(f" {word} ", (-1, len(word) + 1))
        found.make_automaton()
        return found


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(toxic, entry) for each distinct word and beginning of a word of each text."""
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        labels = batch.column("toxic").to_pylist()
        found: dict[int, set[bytes]] = {}
        for raw, rows, starts in slices(data, offsets):
            folded = _fold(raw)[0]
            for row, start, end in zip(rows.tolist(), starts, np.append(starts[1:], len(folded)), strict=True):
                own = found.setdefault(row, set())
                for word in set(folded[start:end].tobytes().split()):
                    own.add(word[:64] + b" ")
                    own.update(word[:n] for n in range(SHORTEST, min(LONGEST, len(word)) + 1))
            for row in [r for r in found if r < rows[-1]]:
                own = found.pop(row)
                yield _labelled(labels[row], own)
        for row, own in found.items():
            yield _labelled(labels[row], own)


def _labelled(label: int, entries: set[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([label] * len(entries), pa.int32()), pa.array(list(entries), pa.binary())], ["toxic", "entry"]
    )


def _log_odds(toxic: np.ndarray, clean: np.ndarray, all_toxic: int, all_clean: int) -> np.ndarray:
    toxic, clean = np.maximum(toxic, 0), np.maximum(clean, 0)
    return np.log((toxic + 0.1) / (all_toxic + 1)) - np.log((clean + 0.5) / (all_clean + 1))


def learn_lexicon(labelled: DataFrame, least: int, most: int) -> Lexicon:
    """The ``most`` entries of highest evidence among those in at least ``least`` toxic texts.

    ``labelled`` is bounded; it is counted in Spark and only the entries kept reach the driver.
    """
    sizes = labelled.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") != 1)).first()
    entries = labelled.select("text", F.col("toxic").cast("int")).mapInArrow(_entries, "toxic int, entry binary")
    counts = entries.groupBy("entry").agg(F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if(F.col("toxic") != 1).alias("clean"))
    rate = (F.col("toxic") / max(sizes[0], 1)) / ((F.col("clean") + 0.5) / (sizes[1] + 1))
    telling = counts.where((F.col("toxic") >= least) & (rate >= 4))
    evidence = F.col("toxic") * F.log(rate)
    kept = telling.orderBy(evidence.desc(), "entry").limit(most).collect()
    toxic = np.array([r["toxic"] for r in kept], float)
    clean = np.array([r["clean"] for r in kept], float)
    weights = [_log_odds(toxic, clean, *sizes), _log_odds(toxic, clean - 1, *sizes), _log_odds(toxic - 1, clean, *sizes)]
    return Lexicon([bytes(r["entry"]) for r in kept], np.maximum(np.array(weights), 0))


def _features(lexicon: Lexicon, automaton, texts: pa.Array, view: np.ndarray) -> np.ndarray:
    """One row of features per text. ``view`` picks the lexicon's weights: 0 as learned, 1 less a clean text, 2 less a toxic one."""
    data, offsets = utf8(texts)
    sums = {name: np.zeros(len(texts)) for name in ("bytes", "words", "capitals", "shouted", "punctuation", "exclamations", "inside", "weight", "hits", "best", "second", "near", "second_person", "disguised")}
    seen: list[set[int]] = [set() for _ in range(len(texts))]
    for raw, rows, starts in slices(data, offsets):
        folded, inside = _fold(raw)
        letter = folded != SPACE
        begins = letter & ~np.append(False, letter[:-1])
        capital = CAPITAL[raw]
        shouted = capital & np.append(capital[1:], False) & ~np.append(False, capital[:-1])
        for name, mask in (("words", begins), ("capitals", capital), ("shouted", shouted), ("punctuation", PUNCTUATION[raw]), ("exclamations", raw == 33), ("inside", inside)):
            np.add.at(sums[name], rows, np.add.reduceat(mask, starts, dtype=np.int64))
        np.add.at(sums["bytes"], rows, np.diff(np.append(starts, len(raw))) - 1)
        found = [(end - length, number) for end, (number, length) in automaton.iter(folded.tobytes().decode("latin-1"))]
        if not found:
            continue
        places, numbers = np.array(found).T
        persons = np.sort(places[numbers < 0])
        owner = np.searchsorted(starts, persons, side="right") - 1
        np.add.at(sums["second_person"], rows[owner], 1)
        places, numbers = places[numbers >= 0], numbers[numbers >= 0]
        row = rows[np.searchsorted(starts, places, side="right") - 1]
        weight = lexicon.weights[view[row], numbers]
        order = np.lexsort((-weight, places))
        first = order[np.append(True, np.diff(places[order]) > 0)] if len(order) else order
        places, numbers, row, weight = places[first], numbers[first], row[first], weight[first]
        kept = weight > 0
        places, numbers, row, weight = places[kept], numbers[kept], row[kept], weight[kept]
        if not len(row):
            continue
        near = np.zeros(len(places), bool)
        if len(persons):
            right = np.searchsorted(persons, places)
            for other in (np.clip(right, 0, len(persons) - 1), np.clip(right - 1, 0, len(persons) - 1)):
                near |= np.abs(persons[other] - places) <= NEAR
        signs = np.cumsum(np.append(0, inside))
        length = np.array([len(e) for e in lexicon.entries])[numbers]
        disguised = signs[np.minimum(places + length + 1, len(raw))] > signs[places]
        for name, value in (("weight", weight), ("hits", 1), ("near", near), ("disguised", disguised)):
            np.add.at(sums[name], row, value)
        for r, n, w in zip(row.tolist(), numbers.tolist(), weight.tolist(), strict=True):
            seen[r].add(n)
            if w > sums["best"][r]:
                sums["best"][r], sums["second"][r] = w, sums["best"][r]
            elif w > sums["second"][r]:
                sums["second"][r] = w
    words, size = np.maximum(sums["words"], 1), np.maximum(sums["bytes"], 1)
    return np.column_stack(
        [
            sums["weight"] / words,
            sums["hits"] / words,
            sums["best"],
            sums["second"],
            [len(s) for s in seen],
            sums["near"] / np.maximum(sums["hits"], 1),
            sums["second_person"] / words,
            sums["capitals"] / size,
            sums["shouted"] / words,
            sums["punctuation"] / size,
            sums["exclamations"] / size,
            sums["inside"] / words,
            sums["disguised"] / words,
            np.log1p(sums["words"]),
        ]
    )


def _training_rows(lexicon: Lexicon, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton = lexicon.automaton()
    for batch in batches:
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
        features = _features(lexicon, automaton, batch.column("text"), np.where(toxic == 1, 2, 1))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("toxic"), pa.array(list(features), pa.list_(pa.float64()))],
            ["doc_id", "toxic", "features"],
        )


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    trees: Trees
    margins: np.ndarray
    chances: np.ndarray

    def score(self, features: np.ndarray) -> np.ndarray:
        margin = self.trees.margin(features)
        # Within a step of the calibration, the margin still orders texts, by less than it can show.
        return np.clip(np.interp(margin, self.margins, self.chances) + 1e-6 * (sigmoid(margin) - 0.5), 0, 1)


def fit(docs: DataFrame, labels: DataFrame, rows: int = 20_000, least: int = 3, entries: int = 4000, folds: int = 5) -> ToxicityModel | None:
    """Fit to the texts of ``docs`` (doc_id, text) whose ``labels`` (doc_id, toxic) are 0 or 1.

    At most ``rows`` labels are used, chosen by a hash of their ids. A document labelled both ways
    counts as toxic. Without any toxic or any other text there is no model.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
    chosen = known.select("doc_id", "toxic").orderBy(sample_key("doc_id"), "toxic").limit(rows)
    chosen = chosen.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    texts = docs.where(F.col("text").isNotNull()).select("doc_id", "text")
    # The labels chosen are at most ``rows`` pairs of numbers.
    labelled = saved(texts.join(F.broadcast(chosen), "doc_id"), "labelled-texts")
    lexicon = learn_lexicon(labelled, least, entries)
    schema = "doc_id bigint, toxic int, features array<double>"
    read = labelled.select(F.col("doc_id").cast("bigint"), "toxic", "text")
    sample = read.mapInArrow(partial(_training_rows, lexicon), schema).orderBy("doc_id", "features").toPandas()
    y = sample["toxic"].to_numpy(float)
    if len(np.unique(y)) < 2:
        return None
    x = np.array(sample["features"].to_list())
    fold = np.arange(len(y)) % folds
    margin = np.zeros(len(y))
    for k in range(folds):
        used = fold != k
        if used.all() or len(np.unique(y[used])) < 2:
            used = np.ones(len(y), bool)
        margin[fold == k] = fit_trees(x[used], y[used]).margin(x[fold == k])
    return ToxicityModel(lexicon, fit_trees(x, y), *isotonic(margin, y))


def _score(model: ToxicityModel, threshold: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton = model.lexicon.automaton()
    for batch in batches:
        score = model.score(_features(model.lexicon, automaton, batch.column("text"), np.zeros(batch.num_rows, np.int64)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
            ["doc_id", "held_out", "score", "predicted"],
        )


def score_documents(docs: DataFrame, model: ToxicityModel | None, held_out: Column, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted for every row; a null text scores as an empty one.

    Without a model every score is 0.
    """
    read = docs.select(F.col("doc_id").cast("bigint"), "text", held_out.alias("held_out"))
    if model is None:
        return read.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    return read.mapInArrow(partial(_score, model, threshold), "doc_id bigint, held_out boolean, score double, predicted int")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document; learn from labels of rows whose remainder by 3 is not 1."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit(docs, labels.where(remainder("doc_id", 3) != 1))
    return score_documents(docs, model, F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)))
