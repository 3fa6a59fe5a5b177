"""Language identification with averaged hashed subword embeddings and a linear softmax.

A text is the mean of the embeddings of its subwords: byte n-grams of its words, hashed to a fixed
number of buckets. A linear softmax reads the mean. Both are trained by stochastic gradient descent
in numpy on a bounded, stratified sample of labelled rows. Half of the held-back part of the sample
fits a temperature, which calibrates the probability, and the threshold below which a prediction is
rejected.

As the model is linear in the mean, embeddings and softmax fold into one table of scores per bucket,
which is what scoring reads: whole texts, in slices of bounded size, in one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewarden.llm.common import FOLD, ngram_buckets, remainder, sample_key, slices, table, utf8

SIZES = (2, 3, 4)
BITS = 15
UNKNOWN = "und"


@dataclass
class LanguageModel:
    """``scores``: one row per bucket, one column per language."""

    languages: list[str]
    scores: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, buckets, counts) of each text: what training reads of it, at most one entry per bucket."""
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        total: dict[int, np.ndarray] = {}
        for raw, rows, starts in slices(data, offsets):
            folded = FOLD[raw]
            found = [ngram_buckets(folded, n, BITS) for n in SIZES]
            ends = np.append(starts[1:], len(folded))
            for row, start, end in zip(rows.tolist(), starts, ends, strict=True):
                seen = np.bincount(np.concatenate([b[start:end] for b in found]), minlength=1 << BITS)
                total[row] = total[row] + seen if row in total else seen
                if row - 1 in total:
                    _shrink(total, row - 1)
        for row in list(total):
            _shrink(total, row)
        pairs = [total[row] for row in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("lang"),
                pa.array([p[0] for p in pairs], pa.list_(pa.int32())),
                pa.array([p[1] for p in pairs], pa.list_(pa.int32())),
            ],
            ["lang", "buckets", "counts"],
        )


def _shrink(total: dict, row: int) -> None:
    if not isinstance(total[row], tuple):
        full = total[row]
        full[0] = 0
        kept = np.flatnonzero(full).astype(np.int32)
        total[row] = (kept, full[kept].astype(np.int32))


def training_sample(docs: DataFrame, per_language: int, in_all: int) -> DataFrame:
    """About ``per_language`` labelled rows of each language, fewer where that would be more than ``in_all``.

    Of a language with fewer rows all are taken, so every language is learned, however rare.

    Each language has its own share of the hash range, so no language is gathered in one place.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    # One row per language.
    sizes = known.groupBy("lang").count().orderBy("lang").collect()
    if not sizes:
        return known.limit(0)
    per_language = max(1, min(per_language, in_all // len(sizes)))
    share = F.create_map(*[F.lit(x) for row in sizes for x in (row["lang"], min(1.0, per_language / row["count"]))])
    place = (F.pmod(sample_key("doc_id", "text"), F.lit(1_000_003)) + 0.5) / 1_000_003
    most = 2 * per_language * len(sizes)
    return known.where(place < F.element_at(share, F.col("lang"))).orderBy(sample_key("doc_id", "text")).limit(most)


def fit(
    docs: DataFrame,
    per_language: int = 600,
    in_all: int = 60_000,
    dimensions: int = 16,
    epochs: int = 12,
    rate: float = 4.0,
    rejected: float = 0.01,
    seed: int = 7,
) -> LanguageModel | None:
    """Fit to rows of (doc_id, text, lang); rows without text or language are left out.

    The driver holds bucket counts of at most about ``2 * in_all`` texts, and one row per language. Rows
    that repeat are drawn alike. Without any labelled row there is no model.
    """
    sample = training_sample(docs.select("doc_id", "text", "lang"), per_language, in_all)
    counted = sample.mapInArrow(_counts, "lang string, buckets array<int>, counts array<int>").toPandas()
    counted = counted[counted["buckets"].map(len) > 0].reset_index(drop=True)
    if counted.empty:
        return None
    names = sorted(counted["lang"].unique())
    label = counted["lang"].map({name: i for i, name in enumerate(names)}).to_numpy()
    buckets = [np.asarray(b, np.int64) for b in counted["buckets"]]
    weights = [np.asarray(c) / np.sum(c) for c in counted["counts"]]
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(label))
    held, used = order[: len(order) // 5], order[len(order) // 5 :]
    vectors = rng.normal(0, 0.1, (1 << BITS, dimensions))
    weight, bias = np.zeros((dimensions, len(names))), np.zeros(len(names))
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for part in np.array_split(rng.permutation(used), max(1, len(used) // 32)):
            ids = np.concatenate([buckets[i] for i in part])
            share = np.concatenate([weights[i] for i in part])
            starts = np.cumsum([0] + [len(buckets[i]) for i in part[:-1]])
            mean = np.add.reduceat(vectors[ids] * share[:, None], starts)
            wrong = _softmax(mean @ weight + bias)
            wrong[np.arange(len(part)), label[part]] -= 1
            wrong /= len(part)
            back = wrong @ weight.T
            weight -= step * (mean.T @ wrong)
            bias -= 0.1 * step * wrong.sum(0)
            per_id = np.repeat(back, np.diff(np.append(starts, len(ids))), axis=0) * share[:, None]
            np.add.at(vectors, ids, -step * len(part) * per_id)
    scores = vectors @ weight
    check = held if len(held) else used
    logits = np.array([weights[i] @ scores[buckets[i]] + bias for i in check])
    heat = min(
        np.geomspace(0.05, 20, 60),
        key=lambda t: -np.log(_softmax(logits / t)[np.arange(len(check)), label[check]] + 1e-12).mean(),
    )
    threshold = float(np.quantile(_softmax(logits / heat).max(1), rejected))
    return LanguageModel(names, scores.astype(np.float32), bias, float(heat), threshold)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _predict(model: LanguageModel, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        total = np.zeros((batch.num_rows, len(model.languages)))
        number = np.zeros(batch.num_rows)
        for raw, rows, starts in slices(data, offsets):
            folded = FOLD[raw]
            for n in SIZES:
                found = ngram_buckets(folded, n, BITS)
                at = np.minimum(starts, len(found) - 1)
                np.add.at(number, rows, np.add.reduceat(found > 0, at, dtype=np.int64))
                np.add.at(total, rows, np.add.reduceat(model.scores[found], at, axis=0, dtype=np.float64))
                np.add.at(total, rows, -np.add.reduceat(found == 0, at, dtype=np.int64)[:, None] * model.scores[0])
        mean = total / np.maximum(number, 1)[:, None] + model.bias
        chance = _softmax(mean / model.temperature)
        best = chance.argmax(1)
        known = batch.column("has_letter").to_numpy(zero_copy_only=False).astype(bool)
        score = np.where(known, chance.max(1), 0.0)
        names = [model.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("held_out"),
                pa.array(names, pa.string()),
                pa.array(score, pa.float64()),
                pa.array(score < model.threshold),
            ],
            ["doc_id", "held_out", "lang_pred", "score", "rejected"],
        )


def predict(docs: DataFrame, model: LanguageModel | None, held_out: Column) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score, rejected.

    ``lang_pred`` is ``und`` and ``score`` 0 where the text is null or has no letter, or no model
    could be fitted. ``rejected`` marks scores below the calibrated threshold.
    """
    has_letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    read = docs.select("doc_id", "text", held_out.alias("held_out"), has_letter.alias("has_letter"))
    schema = "doc_id bigint, held_out boolean, lang_pred string, score double, rejected boolean"
    if model is None:
        return read.select(
            F.col("doc_id").cast("bigint"),
            "held_out",
            F.lit(UNKNOWN).alias("lang_pred"),
            F.lit(0.0).alias("score"),
            F.lit(True).alias("rejected"),
        )
    return read.withColumn("doc_id", F.col("doc_id").cast("bigint")).mapInArrow(partial(_predict, model), schema)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predict the language of every document; learn from rows whose remainder by 4 is not 2."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(remainder("doc_id", 4) != 2))
    return predict(docs, model, F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)))
