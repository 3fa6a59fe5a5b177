"""Small tables with every kind of odd row, and empty ones."""

import math
import random

import pytest

from tests.llm import brute
from tests.llm.brute import ODD_TEXTS, family

SF = "/root/testdata/sf0.001"
#: Columns that clash with names the operators use themselves.
EXTRA = ("score", "kept", "key", "class_id", "packed", "start", "spans", "label", "rank", "ids", "n", "visitor")


def _write(df, folder, name):
    df.write.parquet(f"{folder}/{name}.parquet")


@pytest.fixture(scope="session")
def odd_dir(spark, tmp_path_factory):
    """sf0.001 with odd texts, copies, null cells, a null id, repeated rows and clashing columns."""
    folder = str(tmp_path_factory.mktemp("odd"))
    base = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in base.collect()]
    texts = [*ODD_TEXTS, *family(random.Random(3)), rows[5][1], rows[5][1] + " end", f"before {rows[7][1]}"]
    added = [(1000 + i, text, "en" if i % 3 else None, None if i % 4 == 0 else "src1", None if i % 5 == 0 else 7) for i, text in enumerate(texts)]
    added += [(None, "A text without an id, of more than five words.", None, None, None), added[8], added[8]]
    docs = spark.createDataFrame(rows + added, base.schema)
    for n, name in enumerate(EXTRA):
        docs = docs.selectExpr("*", f"'{n}' AS {name}")
    _write(docs, folder, "documents")
    labels = [tuple(r) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()]
    labels += [(None, 1, 1), (1001, None, 1), (1002, 1, None), labels[0], (labels[1][0], 1 - labels[1][1], 1 - labels[1][2]), (99999, 1, 0)]
    _write(spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").selectExpr("*", "'x' AS text", "1 AS label"), folder, "labels")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    items += [(None, "An item without an id that no document holds at all."), (900, None), (901, ""), (902, "!"), items[0]]
    _write(spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "1 AS doc_id"), folder, "benchmark")
    rng = random.Random(8)
    vectors = [(i, [round(rng.uniform(-1, 1), 1) for _ in range(20)]) for i in range(260)]
    vectors += [(300, vectors[0][1]), (301, vectors[0][1]), (350, vectors[50][1]), vectors[100], vectors[100]]
    vectors += [(400, None), (401, [1.0, None] * 10), (450, [math.nan] * 20), (451, [math.inf] * 20), (452, []), (500, [0.5] * 3), (None, [0.1] * 20)]
    _write(spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>").selectExpr("*", "'x' AS v", "1 AS score", "2 AS qb"), folder, "embeddings")
    turns = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    turns += brute.odd_turns(random.Random(6))
    turns = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    _write(turns.selectExpr("*", "'x' AS fault", "1 AS step", "2 AS copy", "true AS here"), folder, "conversations")
    return folder


@pytest.fixture(scope="session")
def empty_dir(spark, odd_dir, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    for name in ("documents", "labels", "benchmark", "embeddings", "conversations"):
        _write(spark.read.parquet(f"{odd_dir}/{name}.parquet").limit(0), folder, name)
    return folder
