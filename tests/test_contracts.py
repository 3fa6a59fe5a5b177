"""Rows that do not fit, files that are easily lost, names that are not owned."""

import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakewarden.operators.inventory import directory_size, top_level_sizes
from lakewarden.operators.sync import SyncConfig, owned_targets, to_create
from lakewarden.plans.ingest import ingest_files, load_csv
from lakewarden.sinks.tables import append_table, copy_dataset
from lakewarden.sources.catalog import catalog_snapshot
from lakewarden.sources.files import scan_binary
from lakewarden.sources.inventory import inventory
from lakewarden.streaming.arrivals import ingest_new_files
from tests.helpers import targets_of


@pytest.mark.parametrize("columns", ["id int, v string, w int", "id int, vv string", "id int", "id bigint, v string", "id int, v int"])
def test_append_rejects_other_columns(spark, tmp_path, columns):
    target = str(tmp_path / "t")
    append_table(spark.createDataFrame([(1, "a")], "id int, v string"), target)
    rows = spark.createDataFrame([], StructType.fromDDL(columns))
    with pytest.raises(ValueError, match="do not fit"):
        append_table(rows, target)
    assert spark.read.parquet(target).count() == 1


def test_append_widens_and_reorders(spark, tmp_path):
    target = str(tmp_path / "t")
    append_table(spark.createDataFrame([(1, "a")], "id bigint, v string"), target)
    append_table(spark.createDataFrame([("b", 2)], "v string, id int"), target)
    assert sorted(map(tuple, spark.read.parquet(target).collect())) == [(1, "a"), (2, "b")]


def test_append_csv_reads_under_the_tables_columns(spark, tmp_path):
    target = str(tmp_path / "t")
    for name, text in (("big.csv", "id,v\n5000000000,x\n"), ("small.csv", "id,v\n1,2\n"), ("bad.csv", "id,v\nx,y\n")):
        (tmp_path / name).write_text(text)
    load_csv(spark, str(tmp_path / "big.csv"), target)
    load_csv(spark, str(tmp_path / "small.csv"), target)
    assert sorted(map(tuple, spark.read.parquet(target).collect())) == [(1, "2"), (5000000000, "x")]
    with pytest.raises(Exception, match="MALFORMED|CANNOT_PARSE|x"):
        load_csv(spark, str(tmp_path / "bad.csv"), target)
    assert spark.read.parquet(target).count() == 2


def test_copy_keeps_columns_layout_and_partition_text(spark, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    spark.createDataFrame([(1, "007")], "id int, code string").write.partitionBy("code").parquet(source)
    spark.createDataFrame([(2, 5, "010")], "id int, w int, code string").write.mode("append").partitionBy("code").parquet(source)
    assert copy_dataset(spark, source, target).rows == 2
    assert sorted(os.path.basename(p) for p in (str(x) for x in (tmp_path / "t").iterdir()) if "=" in p) == ["code=007", "code=010"]
    assert set(spark.read.option("mergeSchema", True).parquet(target).columns) == {"id", "w", "code"}
    with pytest.raises(ValueError, match="not tables"):
        copy_dataset(spark, source, str(tmp_path / "u"), fmt="csv")


def test_a_file_that_lands_during_a_copy_is_not_removable(spark, tmp_path):
    source = str(tmp_path / "s")
    spark.range(10).write.parquet(source)
    result = copy_dataset(spark, source, str(tmp_path / "t"), move=True)
    spark.range(5).write.mode("append").parquet(source)
    named = [r["path"] for r in result.removable.collect()]
    assert spark.read.parquet(*named).count() == result.rows == 10


@pytest.mark.parametrize("files_per_batch", [None, 1])
def test_stream_takes_old_files(spark, tmp_path, files_per_batch):
    source, target = tmp_path / "in", str(tmp_path / "t")
    source.mkdir()

    def land(name, days):
        (source / name).write_text(f"{name}\n")
        os.utime(source / name, (time.time() - days * 86400,) * 2)

    schema = StructType.fromDDL("name string")
    land("new.csv", 0)
    ingest_new_files(spark, str(source), target, schema, str(tmp_path / "c"), files_per_batch=files_per_batch)
    land("old.csv", 400)
    land("fresh.csv", 0)
    ingest_new_files(spark, str(source), target, schema, str(tmp_path / "c"), files_per_batch=files_per_batch)
    assert sorted(r[0] for r in spark.read.parquet(target).collect()) == ["fresh.csv", "new.csv", "old.csv"]


def test_hidden_files_listed_by_path_are_an_error(spark, tmp_path):
    for name in ("a.csv", "_b.csv"):
        (tmp_path / name).write_text("x\n")
    listed = [str(tmp_path / "a.csv"), str(tmp_path / "_b.csv")]
    with pytest.raises(ValueError, match="_b.csv"):
        ingest_files(spark, listed, str(tmp_path / "t"), StructType.fromDDL("v string"))
    with pytest.raises(ValueError, match="_b.csv"):
        scan_binary(spark, listed)


def test_tables_without_a_name_are_not_created(spark):
    assert to_create(targets_of(spark, None, "a"), targets_of(spark, "b")).collect() == [("a",)]


@pytest.mark.parametrize("schemas", [("a", "b_c"), ("a", "b_c", *(f"s{i}" for i in range(2000)))])
def test_owned_names_of_few_and_many_schemas(spark, schemas):
    names = ["uc_g_a_t", "uc_g_b_c_t", "uc_g_b_t", "uc_g_ab_t", "uc_g_a", "uc_x_a_t", "g_a_t", None]
    owned = owned_targets(targets_of(spark, *names), SyncConfig("g", schemas))
    assert sorted(r[0] for r in owned.collect()) == ["uc_g_a_t", "uc_g_b_c_t"]


def test_inventory_of_absolute_paths(spark, tmp_path):
    rows = [("/a", True, 0), ("/a//x", False, 5), ("/b/", True, 0)]
    spark.createDataFrame(rows, "path string, is_dir boolean, length bigint").write.parquet(str(tmp_path / "i"))
    listing = inventory(spark, str(tmp_path / "i"))
    assert sorted(r["path"] for r in listing.collect()) == ["a", "a/x", "b"]
    assert directory_size(listing, "a").first()["bytes"] == 5


def test_inventory_and_catalog_need_their_fields(spark, tmp_path):
    spark.createDataFrame([("a", 1)], "path string, length bigint").write.parquet(str(tmp_path / "i"))
    with pytest.raises(ValueError, match="is_dir"):
        inventory(spark, str(tmp_path / "i"))
    (tmp_path / "rows.json").write_text('{"path":"a","isdir":true,"len":0}\n')
    with pytest.raises(Exception, match="is_dir"):
        inventory(spark, str(tmp_path / "rows.json"), fmt="json").collect()
    (tmp_path / "catalog.json").write_text('{"catalog_name":"c","schema":"s","name":"t"}\n')
    with pytest.raises(Exception, match="schema_name"):
        catalog_snapshot(spark, str(tmp_path / "catalog.json")).select(F.col("schema_name")).collect()


def test_top_level_folders_without_files_have_no_bytes(spark):
    rows = [("a", True, 0), ("a/x", False, 5), ("b", True, 0), ("b/c", True, 0), ("f", False, 2)]
    listing = spark.createDataFrame(rows, "path string, is_dir boolean, length bigint")
    assert sorted(map(tuple, top_level_sizes(listing).collect())) == [("a", 5), ("b", 0), ("f", 2)]
