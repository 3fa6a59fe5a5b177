"""Equality matching of names that stays balanced when one name dominates.

The reference side of a match is reduced to one row per key before it is shuffled, so a key that is
repeated there collapses inside each map task. The other side keeps its duplicates; if one key holds
a large share of them, adaptive execution splits that shuffle partition across tasks. It can do so
only when the join reads both inputs straight from shuffles it added itself, and an aggregate on the
key alone would be joined without one. ``one_row_per_key`` therefore groups on the key plus its hash:
the groups are the same, the partitioning is not reused, and the join gets its own shuffle of the
already reduced rows.

Broadcasting is left to the optimizer, which checks sizes at run time; only a filter of fixed size is
broadcast outright.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_row_per_key(df: DataFrame, key: str, *aggregates: Column) -> DataFrame:
    """Group by ``key``; the result is laid out so that a later join on ``key`` can be split."""
    aggregates = aggregates or (F.lit(True).alias("_present"),)
    grouped = df.where(F.col(key).isNotNull()).groupBy(key, F.xxhash64(key).alias("_hash"))
    return grouped.agg(*aggregates).drop("_hash")


def keep_matching(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of ``left`` whose key occurs in ``right``; duplicates of ``left`` survive."""
    return left.join(one_row_per_key(right.select(key), key).select(key), key, "left_semi")


def drop_matching(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of ``left`` whose key does not occur in ``right``; duplicates of ``left`` survive."""
    return left.join(one_row_per_key(right.select(key), key).select(key), key, "left_anti")


def flag_matching(left: DataFrame, right: DataFrame, key: str, flag: str) -> DataFrame:
    """All rows of ``left`` with a boolean column telling whether the key occurs in ``right``."""
    present = one_row_per_key(right.select(key), key, F.lit(True).alias(flag))
    matched = left.join(present, key, "left")
    return matched.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def flag_listed(left: DataFrame, listing: DataFrame, key: str, flag: str) -> DataFrame:
    """As ``flag_matching``, for a listing that may be far larger than ``left``.

    Rows of the listing that nobody asks for are dropped in its scan by a filter of the keys. What is
    left is combined in map tasks, so the shuffle carries a key once per task, however often it is
    listed.
    """
    return flag_matching(left, narrowed(listing.select(key), key, left), key, flag)


#: Bits of a filter of keys; its rows, one per 64 bits, are all that is ever broadcast of it.
FILTER_BITS = 1 << 23


def narrowed(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``key`` may be one of ``wanted`` (a column of that name and type), found without a shuffle.

    A filter of ``FILTER_BITS`` bits, whatever the number of keys, goes to all tasks. It lets all wanted
    rows pass, and few others while the keys are fewer than its bits; a join behind it has to tell.
    """
    place = F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))
    bit = F.expr("shiftleft(1L, cast(_place % 64 as int))")
    asked = wanted.where(F.col(key).isNotNull()).select(place.alias("_place"))
    words = asked.groupBy(F.expr("_place div 64").alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    placed = df.withColumn("_place", place).withColumn("_at", F.expr("_place div 64"))
    met = placed.join(F.broadcast(words), placed["_at"] == words["_word"])
    return met.where(F.col("_bits").bitwiseAND(bit) != 0).select(*[df[c] for c in df.columns])
