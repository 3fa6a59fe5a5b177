import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lakewarden.operators.sync import SyncConfig
from lakewarden.plans.ingest import ingest_files, load_csv
from lakewarden.schemas import ORDER_SCHEMA
from lakewarden.sinks.tables import append_table, copy_dataset, overwrite_table
from lakewarden.sources.catalog import catalog_snapshot
from lakewarden.sources.files import scan_binary, scan_csv_declared, scan_csv_inferred
from lakewarden.sources.inventory import inventory, list_files, names_in_folder
from tests.helpers import inventory_of

ROW = "1,2,2024-01-01,Ann,ann@example.com,bolt,3,4.50,0.10"


@pytest.fixture
def orders(tmp_path):
    folder = tmp_path / "orders"
    (folder / "deep" / "er").mkdir(parents=True)
    (folder / "plain.csv").write_text(f"{ROW}\n{ROW}\n")
    (folder / "header.csv").write_text(",".join(ORDER_SCHEMA.names) + "\n" + ROW + "\n")
    (folder / "short.csv").write_text("7,8\n")
    (folder / "long.csv").write_text(ROW + ",extra,more\n")
    (folder / "bad_number.csv").write_text(ROW.replace("4.50", "many") + "\n")
    (folder / "empty.csv").write_text("")
    (folder / "deep" / "er" / "nested.csv").write_text(ROW + "\n")
    return folder


def test_declared_scan_pads_cuts_and_keeps_the_header_line(spark, orders):
    rows = scan_csv_declared(spark, str(orders), ORDER_SCHEMA, recursive=True).collect()
    assert len(rows) == 8
    by_number = {}
    for row in rows:
        by_number.setdefault(row.SalesOrderNumber, []).append(row)
    assert by_number["SalesOrderNumber"][0].Tax == "Tax"
    assert by_number["7"][0].SalesOrderLineNumber == "8" and by_number["7"][0].OrderDate is None
    assert sorted(row.UnitPrice for row in by_number["1"]) == ["4.50"] * 5 + ["many"]
    assert all(row.Tax == "0.10" for row in by_number["1"])


def test_declared_scan_can_skip_headers_and_stay_flat(spark, orders):
    flat = scan_csv_declared(spark, str(orders), ORDER_SCHEMA)
    assert flat.count() == 7
    header = scan_csv_declared(spark, str(orders / "header.csv"), ORDER_SCHEMA, header=True)
    assert [row.SalesOrderNumber for row in header.collect()] == ["1"]


def test_ingest_reads_each_file_once_with_lineage(spark, orders, tmp_path):
    target = str(tmp_path / "table")
    loaded = ingest_files(spark, str(orders), target, ORDER_SCHEMA, lineage=True)
    name = F.substring_index("source_file", "/", -1)
    counts = dict(loaded.groupBy(name.alias("name")).count().collect())
    assert counts == {"plain.csv": 2, "header.csv": 2, "short.csv": 1, "long.csv": 1, "bad_number.csv": 1, "nested.csv": 1}


def test_ingest_takes_a_list_of_files_and_appends(spark, orders, tmp_path):
    target = str(tmp_path / "table")
    files = [str(orders / "plain.csv"), str(orders / "short.csv")]
    assert ingest_files(spark, files, target, ORDER_SCHEMA).count() == 3
    assert ingest_files(spark, files, target, ORDER_SCHEMA).count() == 6


def test_missing_source_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException):
        ingest_files(spark, str(tmp_path / "nowhere"), str(tmp_path / "t"), ORDER_SCHEMA)


def test_inferred_types(spark, tmp_path):
    file = tmp_path / "t.csv"
    file.write_text(
        "i,l,d,day,at,flag,s,none\n"
        "1,3000000000,1.5,2024-01-02,2024-01-02 03:04:05,true,x,\n"
        "2,1,2,2024-01-03,2024-01-02 03:04:06,false,y,\n"
    )
    df = scan_csv_inferred(spark, str(file))
    assert [kind for _, kind in df.dtypes] == ["int", "bigint", "double", "date", "timestamp", "boolean", "string", "string"]
    assert [row.none for row in df.collect()] == [None, None]
    declared = scan_csv_inferred(spark, str(file), schema=df.schema)
    assert declared.collect() == df.collect()


def test_load_csv_modes_and_preview(spark, tmp_path):
    file, target = tmp_path / "t.csv", str(tmp_path / "table")
    file.write_text("n\n" + "".join(f"{i}\n" for i in range(8)))
    assert load_csv(spark, str(file), target).count() == 5
    load_csv(spark, str(file), target, mode="append")
    assert spark.read.parquet(target).count() == 16
    load_csv(spark, str(file), target, mode="overwrite")
    assert spark.read.parquet(target).count() == 8
    with pytest.raises(ValueError, match="upsert"):
        load_csv(spark, str(file), target, mode="upsert")


def test_partitioned_writes(spark, tmp_path):
    target = str(tmp_path / "table")
    df = spark.range(10).withColumn("k", F.col("id") % 3)
    append_table(df, target, partition_by=("k",))
    append_table(df, target, partition_by=("k",))
    assert spark.read.parquet(target).count() == 20
    overwrite_table(df.where("k = 1"), target, partition_by=("k",))
    assert spark.read.parquet(target).select("k").distinct().collect()[0].k == 1


def test_copy_and_move(spark, tmp_path):
    source, target = str(tmp_path / "a"), str(tmp_path / "b")
    spark.range(100).write.parquet(source)
    result = copy_dataset(spark, source, target)
    assert (result.rows, result.removable) == (100, None)
    with pytest.raises(AnalysisException, match="already exists"):
        copy_dataset(spark, source, target)
    moved = copy_dataset(spark, source, target, remove_target=True, move=True)
    expected = {f"file:{p}" for p in (tmp_path / "a").glob("*.parquet")}
    assert {row.path for row in moved.removable.collect()} == expected
    assert spark.read.parquet(source).count() == spark.read.parquet(target).count() == 100


def test_copy_of_an_empty_dataset(spark, tmp_path):
    source = str(tmp_path / "a")
    spark.range(0).write.parquet(source)
    assert copy_dataset(spark, source, str(tmp_path / "b")).rows == 0


def test_binary_scan_gives_whole_objects(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "a.bin").write_bytes(b"\x00\xff\n")
    (tmp_path / "b.bin").write_bytes(b"text")
    (tmp_path / "c.txt").write_bytes(b"other")
    rows = scan_binary(spark, str(tmp_path), glob="*.bin").collect()
    assert {row.path.rsplit("/", 1)[1]: bytes(row.content) for row in rows} == {"a.bin": b"\x00\xff\n", "b.bin": b"text"}


def test_listing_gives_relative_paths_without_reading(spark, orders):
    listing = list_files(spark, str(orders))
    assert "content" not in listing._jdf.queryExecution().optimizedPlan().toString().split("Relation")[0]
    assert {row.path: row.length for row in listing.collect()} == {
        str(file.relative_to(orders)): file.stat().st_size for file in orders.rglob("*.csv") if file.stat().st_size
    }


def test_inventory_export_is_read_strictly(spark, tmp_path):
    good, bad = tmp_path / "good.json", tmp_path / "bad.json"
    good.write_text('{"path":"a/","is_dir":true,"length":0}\n{"path":"a/x","is_dir":false,"length":3}\n')
    bad.write_text('{"path":"a/","is_dir":true,"length":"much"}\n')
    rows = inventory(spark, str(good), fmt="json").select("path", "is_dir", "length").collect()
    assert {tuple(row) for row in rows} == {("a", True, 0), ("a/x", False, 3)}
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        inventory(spark, str(bad), fmt="json").collect()


def test_names_in_folder(spark):
    listing = inventory_of(spark, {"Tables/t/x": 1, "top": 1}, ["Tables", "Tables/t", "Tables/u", "Tables_old/v"])
    assert {row.target for row in names_in_folder(listing, "Tables/").collect()} == {"t", "u"}
    assert {row.target for row in names_in_folder(listing, "").collect()} == {"top", "Tables"}


def test_catalog_layouts_agree(spark, tmp_path):
    tables = [
        {"catalog_name": "gold", "schema_name": schema, "name": f"t{i}", "table_type": "MANAGED",
         "data_source_format": "DELTA", "storage_location": "abfss://c@a/x", "owner": "ignored"}
        for schema in ("a", "b", "c") for i in range(4)
    ]
    rows, responses = tmp_path / "rows.json", tmp_path / "responses.json"
    rows.write_text("\n".join(map(json.dumps, tables)))
    pages = [tables[i : i + 5] for i in range(0, len(tables), 5)]
    responses.write_text("\n".join(json.dumps({"tables": page}) for page in pages))
    config = SyncConfig("gold", ("a", "c"))
    first = catalog_snapshot(spark, str(rows), config).collect()
    second = catalog_snapshot(spark, str(responses), config, layout="responses").collect()
    assert len(first) == 8 and sorted(first) == sorted(second)
    assert catalog_snapshot(spark, str(rows)).count() == 12
    with pytest.raises(ValueError, match="layout"):
        catalog_snapshot(spark, str(rows), layout="pages")


def test_malformed_catalog_is_an_error(spark, tmp_path):
    file = tmp_path / "rows.json"
    file.write_text('{"catalog_name":"gold"\n')
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        catalog_snapshot(spark, str(file)).collect()
