"""The search in blocks, slices and rounds against all products."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakewarden.llm import topk
from lakewarden.llm.topk import top_k

K = 3


def all_products(rows, asks):
    """(query_id, rank, vec_id, score) of the best ``K`` of each query id, repeated rows once."""
    rows = set(rows)
    out = []
    for query in {r[0] for r in rows if asks(r[0])}:
        found = [
            (-sum(a * b for a, b in zip(v, w)), vec)
            for own, v in rows
            if own == query
            for vec, w in rows
            if vec != query
        ]
        out += [(query, n + 1, vec, -score) for n, (score, vec) in enumerate(sorted(found)[:K])]
    return Counter(out)


def vectors(n, width, spread, seed):
    """Vectors of very different norms, some of them shorter, with ties, repeated rows and repeated ids."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        v = rng.integers(-spread, spread + 1, rng.integers(0, width + 1) if i % 7 == 0 else width) // (1 + i % 5)
        rows.append((int(i), tuple(int(x) for x in v)))
    rows += [(i + n, rows[i][1]) for i in range(0, n, 9)]
    rows += [(i, rows[i + 1][1]) for i in range(0, n, 11)]
    return rows + rows[: n // 3] + [rows[10]] * (n // 2)


def test_rounds_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_BYTES", 8 * 20 * 16)
    rows = vectors(400, 20, 40, 1)
    df = spark.createDataFrame(rows, "vec_id bigint, v array<bigint>")
    found = top_k(df, F.col("vec_id") % 5 == 0, K)
    assert Counter(tuple(r) for r in found.collect()) == all_products(rows, lambda i: i % 5 == 0)


def test_fewer_candidates_than_asked_for(spark):
    rows = [(0, (1, 2)), (1, (3, -4)), (5, (1,))]
    df = spark.createDataFrame(rows, "vec_id bigint, v array<bigint>")
    found = top_k(df, F.col("vec_id") % 5 == 0, K)
    assert Counter(tuple(r) for r in found.collect()) == all_products(rows, lambda i: i % 5 == 0)
    assert top_k(df.limit(0), F.lit(True), K).collect() == []
    assert top_k(df, F.lit(None).cast("boolean"), K).collect() == []


@pytest.mark.parametrize("spread", [3, 40, 2**28])
def test_slices_and_floors_of_a_task(monkeypatch, spread):
    monkeypatch.setattr(topk, "SLICE", 16)
    rows = sorted(set(vectors(150, 40, spread, 2)))
    asked = [r for r in rows if r[0] % 10 == 0]

    def table(part, **more):
        kinds = [pa.int64(), pa.list_(pa.int64())]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*part), kinds)] + list(more.values()), ["vec_id", "v", *more])

    whole = {}
    for floors in (None, whole):
        floor = pa.array([floors.get(r[0]) if floors else None for r in asked], pa.int64())
        found = topk._best_of_block(K, table(asked, floor=floor), table(rows)).to_pylist()
        best = Counter()
        for query in {r["query_id"] for r in found}:
            mine = sorted((-r["score"], r["vec_id"]) for r in found if r["query_id"] == query)[:K]
            best.update((query, n + 1, vec, -score) for n, (score, vec) in enumerate(mine))
            whole[query] = -mine[-1][0]
        assert best == all_products(rows, lambda i: i % 10 == 0)
