"""Exact top-k search by columnar branch and bound.

Queries and candidates are dealt into blocks, and a pair of blocks is one task's work. There the
candidates lie in vertical layout, one row per dimension, a slice at a time and those of large norm
first. For each query, scores are summed over one block of dimensions after the other. What the
dimensions to come can add or take away is bounded by the product of the remaining norms; candidates
whose best case is below the query's floor or the k-th best worst case are dropped, and the survivors
compacted.

Blocks are as large as a task may hold, so a vector is copied as rarely as it can be. Blocks of
candidates are searched in rounds, each four times as many as all before it. The k-th best score of a
query so far is its floor in the next round: a round finds a few rows per query in expectation, not k
per block, so what meets in the window grows with the logarithm of the number of blocks.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakewarden.llm.common import saved, table

#: Bytes of the vectors of a block, at eight a component.
BLOCK_BYTES = 32 << 20
#: Blocks smaller than these are not made to keep more cores busy.
LEAST_QUERIES = 256
LEAST_CANDIDATES = 4096
#: Candidates that a task searches at once; their dimensions stay in its cache.
SLICE = 4096
DIMENSIONS_AT_ONCE = 16
#: Each round searches this many times the blocks before its end.
GROWTH = 4
RESULT = "query_id bigint, vec_id bigint, score bigint"
NO_FLOOR = np.iinfo(np.int64).min


def scaled(vectors: DataFrame, id_column: str, vector_column: str, factor: int) -> DataFrame:
    """(vec_id, v) with every component as floor(factor * x); rows without a usable vector or id are left out."""
    usable = F.forall(vector_column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = F.transform(vector_column, lambda x: F.floor(x.cast("double") * factor))
    kept = vectors.where(F.col(id_column).isNotNull() & F.col(vector_column).isNotNull() & usable)
    return kept.select(F.col(id_column).cast("bigint").alias("vec_id"), v.alias("v"))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones are filled with zeros."""
    column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width), np.int64)
    out[np.repeat(np.arange(len(column)), lengths), np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = column.flatten().to_numpy()
    return out


def _best_of_block(k: int, queries: pa.Table, candidates: pa.Table) -> pa.Table:
    found: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(3)]
    if queries.num_rows and candidates.num_rows:
        width = max(max(t["v"].combine_chunks().value_lengths().to_numpy().max() for t in (queries, candidates)), 1)
        ids, rows = candidates["vec_id"].to_numpy(), _matrix(candidates["v"], width)
        asked, wanted = queries["vec_id"].to_numpy(), _matrix(queries["v"], width)
        floors = queries["floor"].combine_chunks().fill_null(NO_FLOOR).to_numpy().copy()
        largest = float(np.abs(rows.astype(float)).max()) * float(np.abs(wanted.astype(float)).max())
        exact = largest * width < 2**53
        if exact:
            wanted = wanted.astype(float)
            order = np.argsort(-(rows.astype(float) ** 2).sum(1), kind="stable")
        else:
            order = np.arange(len(ids))
        left = _rest_norms(wanted.T) if exact else None
        best = [np.zeros((0, 2), np.int64)] * len(asked)
        for start in range(0, len(order), SLICE):
            here = order[start : start + SLICE]
            names = ids[here]
            columns = np.ascontiguousarray(rows[here].T, dtype=float if exact else np.int64)
            norms = _rest_norms(columns) if exact else None
            for i, query in enumerate(wanted):
                if exact:
                    at, score = _search(query, left[:, i], columns, norms, names != asked[i], k, floors[i])
                else:  # beyond exact doubles: whole scores in 64-bit integers
                    at = np.flatnonzero(names != asked[i])
                    score = query @ columns[:, at]
                    at, score = at[score >= floors[i]], score[score >= floors[i]]
                if len(at):
                    both = np.concatenate([best[i], np.column_stack([names[at], score.astype(np.int64)])])
                    best[i] = both[np.lexsort((both[:, 0], -both[:, 1]))[:k]]
                    if len(best[i]) == k:
                        floors[i] = max(floors[i], best[i][-1, 1])
        found = [
            [np.repeat(asked, [len(b) for b in best])],
            [b[:, 0] for b in best],
            [b[:, 1] for b in best],
        ]
    return pa.table([np.concatenate(f) for f in found], ["query_id", "vec_id", "score"])


def _rest_norms(columns: np.ndarray) -> np.ndarray:
    """The norm of all dimensions, and after each block of dimensions that of those still to come."""
    squares = columns**2
    ends = range(0, len(columns) + DIMENSIONS_AT_ONCE, DIMENSIONS_AT_ONCE)
    return np.sqrt(np.array([squares[end:].sum(0) for end in ends]))


def _search(
    query: np.ndarray, left: np.ndarray, columns: np.ndarray, norms: np.ndarray, others: np.ndarray, k: int, floor: int
) -> tuple[np.ndarray, np.ndarray]:
    """(places, scores) of all candidates that can be among the best ``k`` and reach the floor, with full scores."""
    # Norms are rounded; a hair more keeps the bounds safe.
    alive = np.flatnonzero(others & (norms[0] * (left[0] * (1 + 1e-9)) + 1e-6 >= floor))
    score = np.zeros(len(alive))
    for block in range(len(norms) - 1):
        if not len(alive):
            break
        dims = slice(block * DIMENSIONS_AT_ONCE, (block + 1) * DIMENSIONS_AT_ONCE)
        whole = len(alive) == columns.shape[1]
        score = score + query[dims] @ (columns[dims] if whole else columns[dims].take(alive, axis=1))
        rest = norms[block + 1] if whole else norms[block + 1][alive]
        rest = rest * (left[block + 1] * (1 + 1e-9)) + (1e-6 if left[block + 1] else 0)
        bar = floor
        if len(score) > k:
            bar = max(bar, np.partition(score - rest, len(score) - k)[len(score) - k])
        keep = score + rest >= bar
        if block == len(norms) - 2 or keep.mean() < 0.8:
            alive, score = alive[keep], score[keep]
    return alive, score


def _blocks(rows: int, most: int, least: int, wanted: int) -> int:
    """Blocks of at most ``most`` rows; ``wanted`` of them if none gets fewer than ``least``."""
    return max(1, -(-rows // most), min(rows // least, wanted))


def top_k(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` largest inner products of each query with other rows.

    ``vectors`` has (vec_id, v), integers; ``is_query`` tells which rows ask. Ties go to the smaller
    id. A row never finds rows of its own id. Fully repeated rows count once; rows that share an id
    but not the vector count each. A shorter vector counts as filled with zeros. Products whose sum
    may exceed 2**53 are summed whole in 64-bit integers. An empty table gives an empty result.
    """
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    asks = F.bool_or(F.coalesce(is_query, F.lit(False))).alias("asks")
    vectors = saved(vectors.groupBy("vec_id", "v").agg(asks), "vectors")
    rows, asking, width = vectors.agg(F.count("*"), F.count_if("asks"), F.max(F.size("v"))).first()
    most = max(1, BLOCK_BYTES // (8 * max(width or 1, 1)))
    candidate_blocks = _blocks(rows, most, LEAST_CANDIDATES, cores)
    query_blocks = _blocks(asking, most, LEAST_QUERIES, -(-cores // candidate_blocks))

    def dealt(df: DataFrame, block: str, blocks: int) -> DataFrame:
        return df.withColumn(block, F.pmod(F.xxhash64(F.lit(block), "vec_id", "v"), F.lit(blocks)))

    def copied(df: DataFrame, block: str, first: int, end: int) -> DataFrame:
        return df.withColumn(block, F.explode(F.sequence(F.lit(first).cast("bigint"), F.lit(end - 1).cast("bigint"))))

    queries = dealt(vectors.where("asks"), "qb", query_blocks).select("vec_id", "v", "qb")
    theirs = dealt(vectors, "cb", candidate_blocks).select(F.col("vec_id").alias("vec_id"), F.col("v").alias("v"), "cb")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    best, done = None, 0
    while done < candidate_blocks:
        end = min(candidate_blocks, done * GROWTH if done else -(-cores // query_blocks))
        if best is None:
            asked = queries.withColumn("floor", F.lit(None).cast("bigint"))
        else:
            floors = best.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("floor"))
            asked = queries.join(floors, "vec_id", "left")
        candidates = copied(theirs.where(F.col("cb").between(done, end - 1)), "qb", 0, query_blocks)
        pairs = copied(asked, "cb", done, end).groupBy("qb", "cb").cogroup(candidates.groupBy("qb", "cb"))
        found = pairs.applyInArrow(partial(_best_of_block, k), RESULT)
        if best is not None:
            found = found.unionByName(best.drop("rank"))
        best = saved(found.withColumn("rank", rank).where(F.col("rank") <= k), "top-k")
        done = end
    return best.select("query_id", "rank", "vec_id", "score")


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other vectors for each vector whose id is divisible by 50."""
    vectors = scaled(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 256)
    return top_k(vectors, F.col("vec_id") % 50 == 0, 5)


OP8_SQL = """
WITH scaled AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scores AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
    FROM scaled q JOIN scaled c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scores
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""
