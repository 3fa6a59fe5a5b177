"""Document quality by co-training.

Two logistic classifiers look at different things: one at the text's content (rates of characters,
repetition, shapes of three characters in a row), one at the page's metadata (source, language and
length as recorded). Both start from the labelled rows. In each round, each labels the unlabelled
rows it is most sure of for the other, in the proportion of the classes. At the end each view is
calibrated on labelled rows kept back for it, and a logistic combination of the calibrated views
scores all documents.

The driver holds features of a bounded sample, a fixed number per row. Scoring is one pass without a
shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewarden.llm.common import SLICE_BYTES, in_parts, remainder, sample_key, saved, sigmoid, slices, table, utf8, words_of

SHAPES = 256
SOURCES, LANGS, LENGTHS = 64, 16, 24
#: A character's kind, as text of shapes has it: lower and upper case, digit, other ASCII as it is.
SHAPE = np.array([97 if chr(b).islower() and b < 128 or b >= 128 else 65 if chr(b).isupper() else 48 if chr(b).isdigit() else b for b in range(256)], np.uint8)
KINDS = {
    "lower": SHAPE == 97,
    "upper": SHAPE == 65,
    "digit": SHAPE == 48,
    "space": np.array([b <= 32 for b in range(256)]),
    "line": np.array([b == 10 for b in range(256)]),
    "mark": np.array([chr(b) in ".,;:?'\"-()" for b in range(256)]),
    "sign": np.array([chr(b) in "#$%&*@^~|<>{}[]=+_\\/" for b in range(256)]),
    "loud": np.array([chr(b) == "!" for b in range(256)]),
}
DENSE = len(KINDS) + 5
FEATURES = "doc_id bigint, label int, text_view array<float>, page_view array<int>"


def text_view(texts: pa.Array) -> np.ndarray:
    """Content features of each text; a null text is an empty one."""
    data, offsets = utf8(texts)
    n = len(texts)
    kinds, shapes = np.zeros((n, len(KINDS))), np.zeros((n, SHAPES))
    size, words, again, fresh = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    # Distinct words of texts that take several slices.
    long_texts: dict[int, np.ndarray] = {int(row): np.zeros(0, np.uint64) for row in np.flatnonzero(np.diff(offsets) > SLICE_BYTES)}
    for raw, rows, starts in slices(data, offsets):
        for k, kind in enumerate(KINDS.values()):
            np.add.at(kinds[:, k], rows, np.add.reduceat(kind[raw], starts, dtype=np.int64))
        np.add.at(size, rows, np.diff(np.append(starts, len(raw))))
        shape = SHAPE[raw].astype(np.uint32)
        code = (shape[:-2] << 16 | shape[1:-1] << 8 | shape[2:]) * np.uint32(2654435761) >> np.uint32(24)
        owner = np.repeat(np.arange(len(rows)), np.diff(np.append(starts, len(raw))))
        counts = np.bincount(owner[: len(code)] * SHAPES + code, minlength=len(rows) * SHAPES)
        np.add.at(shapes, rows, counts.reshape(-1, SHAPES))
        begin, _, hashes = words_of(raw)
        if len(begin):
            row = rows[owner[begin]]
            np.add.at(words, row, 1)
            same = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
            np.add.at(again, row[1:], same)
            for own in long_texts.keys() & set(rows.tolist()):
                long_texts[own] = np.union1d(long_texts[own], hashes[row == own])
            order = np.lexsort((hashes, row))
            differs = np.append(True, (np.diff(row[order]) != 0) | (np.diff(hashes[order]) != 0))
            np.add.at(fresh, row[order], differs)
    for own, seen in long_texts.items():
        fresh[own] = len(seen)
    size, most = np.maximum(size, 1)[:, None], np.maximum(words, 1)
    lengths = np.log1p(words)
    dense = np.column_stack([kinds / size, fresh / most, again / most, lengths / 10, words / size[:, 0], words == 0])
    # Square roots keep rare shapes visible beside frequent ones.
    return np.column_stack([dense, np.sqrt(shapes / size)]).astype(np.float32)


def page_view() -> Column:
    """Places of the ones in the metadata features: source, language, recorded length."""
    length = F.least(F.floor(F.log2(F.greatest("n_chars", F.lit(0)) + 1)), F.lit(LENGTHS - 2)).cast("int")
    places = F.array(
        F.pmod(F.xxhash64(F.coalesce("source", F.lit(""))), F.lit(SOURCES)).cast("int"),
        (F.pmod(F.xxhash64(F.coalesce("lang", F.lit(""))), F.lit(LANGS)) + SOURCES).cast("int"),
        F.coalesce(length + 1, F.lit(0)) + SOURCES + LANGS,
    )
    return places.alias("page_view")


def _page_matrix(places: np.ndarray) -> np.ndarray:
    out = np.zeros((len(places), SOURCES + LANGS + LENGTHS), np.float32)
    out[np.arange(len(places))[:, None], places] = 1
    return out


def _places(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, 3)


@dataclass
class Logistic:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale @ self.weights).astype(np.float64) + self.bias


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 100) -> Logistic:
    """L2-penalised logistic regression on standardised columns, by accelerated gradient descent."""
    mean, scale = x.mean(0), x.std(0) + 1e-3
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))]).astype(np.float32)
    ridge = np.append(np.full(x.shape[1], penalty / len(x)), 0).astype(np.float32)
    v = np.ones(z.shape[1], np.float32)
    for _ in range(20):  # the largest curvature sets the step
        v = z.T @ (z @ v)
        v /= np.linalg.norm(v)
    y = y.astype(np.float32)
    step = 1 / (0.25 * float(v @ (z.T @ (z @ v))) / len(x) + ridge[0])
    w = ahead = np.zeros(z.shape[1], np.float32)
    for t in range(steps):
        new = ahead - step * (z.T @ (sigmoid(z @ ahead) - y) / len(x) + ridge * ahead)
        ahead, w = new + t / (t + 3) * (new - w), new
    return Logistic(mean, scale, w[:-1], float(w[-1]))


def _calibration(margin: np.ndarray, y: np.ndarray) -> Logistic:
    return fit_logistic(np.atleast_2d(margin.T).T, y, penalty=1.0)


@dataclass
class QualityModel:
    text: Logistic
    page: Logistic
    text_scale: Logistic
    page_scale: Logistic
    combined: Logistic
    exchanged: list[tuple[int, int]]

    def views(self, text: np.ndarray, page: np.ndarray) -> np.ndarray:
        """Calibrated log-odds of both views."""
        margins = (self.text.margin(text), self.page.margin(page))
        return np.column_stack([c.margin(m[:, None]) for c, m in zip((self.text_scale, self.page_scale), margins, strict=True)])


def co_train(views: list[np.ndarray], label: np.ndarray, rounds: int, sure: float, share: float) -> tuple[list[Logistic], list[tuple[int, int]]]:
    """Classifiers of two views after exchanging labels; a label below 0 is unknown.

    In each round a view passes on at most ``share`` of the unlabelled rows, the surest of each class
    in the proportion of the classes, and none it is less than ``sure`` of.
    """
    given = [label.astype(float).copy() for _ in views]
    rate = label[label >= 0].mean()
    exchanged = []
    for number in range(rounds + 1):
        models = [fit_logistic(v[g >= 0], g[g >= 0]) for v, g in zip(views, given, strict=True)]
        if number == rounds:
            break
        moved = []
        for own, other in ((0, 1), (1, 0)):
            free = np.flatnonzero(given[other] < 0)
            chance = sigmoid(models[own].margin(views[own][free]))
            count = 0
            for kind, part, certainty in ((1, rate, chance), (0, 1 - rate, 1 - chance)):
                most = int(np.ceil(share * part * len(label)))
                best = np.argsort(-certainty, kind="stable")[:most]
                best = best[certainty[best] >= sure]
                given[other][free[best]] = kind
                count += len(best)
            moved.append(count)
        exchanged.append((moved[0], moved[1]))
    return models, exchanged


def _sample_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_parts(batches):
        features = pa.array(list(text_view(batch.column("text"))), pa.list_(pa.float32()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"), features, batch.column("page_view")],
            ["doc_id", "label", "text_view", "page_view"],
        )


def fit(docs: DataFrame, labels: DataFrame, labelled: int = 8000, unlabelled: int = 8000, rounds: int = 5, sure: float = 0.95, share: float = 0.05) -> QualityModel | None:
    """Fit to ``docs`` (doc_id, text, source, lang, n_chars) and ``labels`` (doc_id, quality of 0 or 1).

    At most ``labelled`` labels and ``unlabelled`` other documents are used, chosen by a hash of their
    ids. A document labelled both ways counts as good. Without labels of both kinds there is no model.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    chosen = known.select("doc_id", "quality").orderBy(sample_key("doc_id"), "quality").limit(labelled)
    chosen = chosen.groupBy("doc_id").agg(F.max("quality").cast("int").alias("label"))
    ids = docs.where(F.col("doc_id").isNotNull()).select("doc_id")
    others = ids.join(known.select("doc_id"), "doc_id", "left_anti")
    others = others.orderBy(sample_key("doc_id")).limit(unlabelled).distinct().withColumn("label", F.lit(-1))
    # At most as many pairs of numbers as the two bounds add up to.
    wanted = F.broadcast(chosen.unionByName(others))
    read = docs.select("doc_id", "text", page_view()).join(wanted, "doc_id")
    read = read.select(F.col("doc_id").cast("bigint"), "label", "text", "page_view")
    sample = saved(read.mapInArrow(_sample_rows, FEATURES), "quality-sample").orderBy("doc_id", "text_view").toArrow()
    label = sample["label"].to_numpy().astype(float)
    if len(np.unique(label[label >= 0])) < 2:
        return None
    text = sample["text_view"].combine_chunks().flatten().to_numpy().reshape(len(label), -1)
    views = [text, _page_matrix(_places(sample["page_view"].combine_chunks()))]
    kept = (np.arange(len(label)) % 4 == 0) & (label >= 0)
    used = ~kept
    if min(len(np.unique(label[part & (label >= 0)])) for part in (kept, used)) < 2:
        kept, used = label >= 0, np.ones(len(label), bool)  # too few to keep any back
    models, exchanged = co_train([v[used] for v in views], label[used], rounds, sure, share)
    margins = [m.margin(v[kept]) for m, v in zip(models, views, strict=True)]
    scales = [_calibration(m[:, None], label[kept]) for m in margins]
    both = np.column_stack([s.margin(m[:, None]) for s, m in zip(scales, margins, strict=True)])
    return QualityModel(*models, *scales, _calibration(both, label[kept]), exchanged)


def _score(model: QualityModel, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        both = model.views(text_view(batch.column("text")), _page_matrix(_places(batch.column("page_view"))))
        score = sigmoid(model.combined.margin(both))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(score), pa.array(sigmoid(both[:, 0])), pa.array(sigmoid(both[:, 1]))],
            ["doc_id", "score", "text_score", "page_score"],
        )


def score_documents(docs: DataFrame, model: QualityModel | None) -> DataFrame:
    """doc_id, score, text_score, page_score of every row; higher is better.

    Null texts and metadata are empty ones. Without a model every score is 1: nothing is rejected.
    """
    read = docs.select(F.col("doc_id").cast("bigint"), "text", page_view())
    if model is None:
        return read.select("doc_id", *[F.lit(1.0).alias(c) for c in ("score", "text_score", "page_score")])
    return read.mapInArrow(partial(_score, model), "doc_id bigint, score double, text_score double, page_score double")


def _mark(model: QualityModel, threshold: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_parts(batches):
        both = model.views(text_view(batch.column("text")), _page_matrix(_places(batch.columns[-1])))
        keep = sigmoid(model.combined.margin(both)) >= threshold
        yield batch.select(batch.schema.names[:-1]).filter(pa.array(keep))


def keep_good(docs: DataFrame, model: QualityModel | None, threshold: float = 0.5) -> DataFrame:
    """Rows of ``docs`` with a score of ``threshold`` or more, all columns as they are.

    Rows that repeat are judged alike, null texts as empty ones; an empty table gives no rows.
    """
    if model is None:
        return docs
    name = "_page_view"
    while name in docs.columns:
        name += "_"
    return docs.select("*", page_view().alias(name)).mapInArrow(partial(_mark, model, threshold), docs.schema)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document; learn from labels of rows whose remainder by 4 is not 3."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit(docs, labels.where(remainder("doc_id", 4) != 3))
    scored = score_documents(docs, model)
    held = F.coalesce(remainder("doc_id", 4) == 3, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "text_score", "page_score")
