import gzip

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from lakewarden.schemas import ORDER_SCHEMA
from lakewarden.sinks.tables import append_once
from lakewarden.streaming.arrivals import ingest_new_files

ROW = "{},1,2024-01-01,Ann,ann@example.com,bolt,3,4.50,0.10\n"


def test_rerun_adds_only_new_files(spark, tmp_path):
    source, target, ledger = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ledger")
    (source / "sub").mkdir(parents=True)
    (source / "a.csv").write_text(ROW.format(1) + ROW.format(2))
    (source / "sub" / "b.csv").write_text(ROW.format(3))

    def run():
        ingest_new_files(spark, str(source), target, ORDER_SCHEMA, ledger, lineage=True)
        return sorted(row.SalesOrderNumber for row in spark.read.parquet(target).collect())

    assert run() == ["1", "2", "3"]
    assert run() == ["1", "2", "3"]
    (source / "sub" / "c.csv").write_text(ROW.format(4))
    assert run() == ["1", "2", "3", "4"]
    names = spark.read.parquet(target).select(F.substring_index("source_file", "/", -1)).distinct().collect()
    assert {row[0] for row in names} == {"a.csv", "b.csv", "c.csv"}


def test_batches_can_be_bounded(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    for i in range(5):
        (source / f"{i}.csv").write_text(ROW.format(i))
    ingest_new_files(spark, str(source), target, ORDER_SCHEMA, str(tmp_path / "ledger"), files_per_batch=2)
    assert spark.read.parquet(target).count() == 5
    commits = [file for file in (tmp_path / "ledger" / "commits").iterdir() if file.name.isdigit()]
    assert len(commits) == 3


def test_a_failed_run_is_made_up_for(spark, tmp_path):
    source, target, ledger = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ledger")
    source.mkdir()
    (source / "a.csv").write_text(ROW.format(1) + ROW.format(2))
    broken = source / "b.csv.gz"
    broken.write_bytes(b"not compressed")
    with pytest.raises(StreamingQueryException):
        ingest_new_files(spark, str(source), target, ORDER_SCHEMA, ledger)
    broken.write_bytes(gzip.compress(ROW.format(3).encode()))
    for _ in range(2):
        ingest_new_files(spark, str(source), target, ORDER_SCHEMA, ledger)
        assert sorted(row.SalesOrderNumber for row in spark.read.parquet(target).collect()) == ["1", "2", "3"]


def test_rows_of_an_existing_table_stay(spark, tmp_path):
    source, target, ledger = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ledger")
    source.mkdir()
    (source / "a.csv").write_text("4\n")
    spark.range(3).write.parquet(target)
    ingest_new_files(spark, str(source), target, "id int", ledger)
    assert sorted(row.id for row in spark.read.parquet(target).collect()) == [0, 1, 2, 4]
    spark.range(10, 11).write.mode("append").parquet(target)
    (source / "b.csv").write_text("5\n")
    ingest_new_files(spark, str(source), target, "id int", ledger)
    assert sorted(row.id for row in spark.read.parquet(target).collect()) == [0, 1, 2, 4, 5, 10]


def test_a_repeated_batch_is_written_once(spark, tmp_path):
    target = str(tmp_path / "out")
    spark.range(2).write.parquet(target)
    for _ in range(2):
        append_once(spark.range(5, 8), target, "parquet", "w", 0)
    append_once(spark.range(5, 8), target, "parquet", "other", 0)
    # A run that broke off after some files had been published: no mark, and files of the batch.
    append_once(spark.range(20, 30).repartition(3), target, "parquet", "w", 1)
    (tmp_path / "out" / "_batches" / "w" / "1").unlink()
    append_once(spark.range(20, 22), target, "parquet", "w", 1)
    assert sorted(row.id for row in spark.read.parquet(target).collect()) == [0, 1, 5, 5, 6, 6, 7, 7, 20, 21]


def test_a_table_kept_by_a_streams_log_is_refused(spark, tmp_path):
    (tmp_path / "out" / "_spark_metadata").mkdir(parents=True)
    with pytest.raises(ValueError, match="log"):
        ingest_new_files(spark, str(tmp_path), str(tmp_path / "out"), ORDER_SCHEMA, str(tmp_path / "ledger"))
