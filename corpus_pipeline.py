"""From raw documents to packed training sequences: five stages, each on all that the one before kept.

Each stage takes ``(spark, docs, sf_dir)``. All but the last return the columns of documents. A stage first has
the executors give back the heap that the ones before have left full of garbage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewarden.llm import decontaminate, neardup, packing, pii, quality
from lakewarden.llm.common import return_heap, saved, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that the co-trained classifier, fitted to the labels of ``docs``, does not reject.

    Null texts are judged as empty ones, rows that repeat are judged alike, and without labels all stay.
    """
    return_heap(spark)
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


#: Similarity in hundredths from which the pipeline takes texts for near duplicates.
NEAR = 80


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str, linked: int = NEAR) -> DataFrame:
    """Keep one document of each group of near duplicates, the one with the smallest id.

    Texts are near duplicates at a similarity of ``linked`` hundredths or more.
    Rows without an id have no duplicates and stay; rows that repeat a kept id stay together. Null and
    empty texts have no duplicates; an empty table stays empty.
    """
    return_heap(spark)
    dropped = neardup.near_duplicates(docs, linked).where(~F.col("kept")).select("doc_id").distinct()
    dropped = saved(dropped, "near-duplicate-ids")
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item; null and empty texts hold none, rows that repeat go together."""
    return_heap(spark)
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data and the terms that disclose it; ``n_chars`` becomes the new length."""
    return_heap(spark)
    clean = pii.sanitize(docs)
    return clean.withColumn("n_chars", F.char_length("text").cast("bigint")) if "n_chars" in docs.columns else clean


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenize and pack into sequences of at most 2048 ids: one row per piece.

    Null and empty texts are one piece, their end id; rows that repeat are packed each.
    """
    return_heap(spark)
    # Workers of earlier stages still hold some memory; small batches leave it to them.
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), batch_rows=300)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: Trained classifiers and sketches are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of ``sf_dir``; each result but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = saved(docs, name)
    return docs
