"""Copies and replacements that must not lose or hide rows."""

import threading

import pytest
from pyspark.sql import functions as F

from lakewarden.session import new_folder
from lakewarden.sinks.tables import copy_dataset, digest, replace_registered

NESTED = "id bigint, m map<string, bigint>, s struct<a: map<int, string>, b: array<map<string, int>>>, `odd.name` string"


def _digest(df):
    return df.agg(*digest(df.schema)).first()


def test_map_columns_are_copied(spark, tmp_path):
    rows = [(1, {"x": 1, "y": 2}, ({1: "a"}, [{"k": 1}]), "d"), (2, None, None, None), (3, {}, (None, [None]), "")]
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame(rows, NESTED).write.parquet(source)
    assert copy_dataset(spark, source, target).rows == 3
    assert sorted(map(str, spark.read.parquet(target).collect())) == sorted(map(str, spark.read.parquet(source).collect()))


def test_digest_ignores_order_of_rows_and_entries(spark):
    one = spark.createDataFrame([(1, {"x": 1, "y": 2}, ({1: "a", 2: "b"}, []), "d"), (2, None, None, None)], NESTED)
    two = spark.createDataFrame([(2, None, None, None), (1, {"y": 2, "x": 1}, ({2: "b", 1: "a"}, []), "d")], NESTED)
    assert _digest(one) == _digest(two)


@pytest.mark.parametrize(
    ("left", "right"),
    [
        ([(1, "a"), (1, "a"), (2, "b"), (3, "c")], [(2, "b"), (2, "b"), (2, "b"), (3, "c")]),
        ([(1, "a"), (1, "a"), (9, "z")], [(5, "q"), (5, "q"), (9, "z")]),
        ([(None, "a")], [(None, None)]),
    ],
)
def test_digest_sees_repeated_rows_and_nulls(spark, left, right):
    a, b = (spark.createDataFrame(rows, "id bigint, name string") for rows in (left, right))
    assert _digest(a) != _digest(b)


def test_digest_sees_in_which_column_a_null_stands(spark):
    a, b = (spark.createDataFrame(rows, "x bigint, y bigint") for rows in ([(1, None)], [(None, 1)]))
    assert _digest(a) != _digest(b)


def test_readers_find_old_or_new_rows_during_a_replacement(spark):
    name = "replaced_while_read"
    spark.range(100).write.parquet(first := new_folder(spark, "first"))
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{first}'")
    seen, stop = set(), threading.Event()

    def read():
        while not stop.is_set():
            seen.add(spark.table(name).count())

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for n in (70, 50):
            old = replace_registered(spark.range(n), name, new_folder(spark, "next"))
        assert spark.table(name).count() == 50 and spark.read.parquet(old).count() == 70
    finally:
        stop.set()
        reader.join()
        spark.sql(f"DROP TABLE {name}")
    assert seen <= {100, 70, 50} and len(seen) > 1


def test_a_failed_replacement_changes_nothing(spark):
    name = "not_replaced"
    spark.range(10).write.parquet(first := new_folder(spark, "first"))
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{first}'")
    broken = spark.range(10).select(F.assert_true(F.col("id") < 5).isNull().cast("bigint").alias("id"))
    try:
        with pytest.raises(Exception, match="(?i)assert|not true|USER_RAISED"):
            replace_registered(broken, name, new_folder(spark, "next"))
        with pytest.raises(ValueError, match="fit"):
            replace_registered(spark.range(3).withColumnRenamed("id", "other"), name, new_folder(spark, "next"))
        assert spark.table(name).count() == 10
    finally:
        spark.sql(f"DROP TABLE {name}")
