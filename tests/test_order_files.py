"""The order files: what moves to write them, and how they are read."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from lakewarden import inputs
from lakewarden.session import settings, without_sorts


@pytest.fixture
def tables(spark, tmp_path):
    """Lines that share keys, or have none, and an order without a date."""
    spark.sql("SELECT explode(array(1L, 2L, NULL)) AS c_custkey, 'Customer#1' AS c_name").write.parquet(f"{tmp_path}/customer.parquet")
    spark.sql("SELECT explode(array(1L, 1L, 2L)) AS p_partkey, 'bolt' AS p_name, 1.5D AS p_retailprice").write.parquet(f"{tmp_path}/part.parquet")
    orders = spark.range(100).select(
        F.col("id").alias("o_orderkey"),
        (F.col("id") % 3).alias("o_custkey"),
        F.expr("CASE WHEN id > 1 THEN make_timestamp(CAST(1900 + id AS INT), 1, 1, 0, 0, 0) END").alias("o_orderdate"),
    )
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    lines = spark.range(1000).selectExpr("nullif(id % 101, 7) AS l_orderkey", "id % 3 AS l_partkey", "1 AS l_linenumber", "2.0D AS l_quantity", "0.1D AS l_tax")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_texts_are_made_after_rows_are_dealt(spark, tables):
    plan = inputs.sales_lines(spark, tables)._jdf.queryExecution().optimizedPlan().toString()
    made, dealt = plan.split("RebalancePartitions")
    assert "@example.com" in made and "@example.com" not in dealt


def test_order_files_are_written_without_sorting(spark, tables, monkeypatch):
    name, writers, write = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.csv
    before = spark.conf.get(name)
    monkeypatch.setattr(DataFrameWriter, "csv", lambda self, folder: (writers.append(int(spark.conf.get(name))), write(self, folder))[1])
    folder = inputs.landed_sales(spark, tables)
    assert min(writers) > 1 and spark.conf.get(name) == before
    written = spark.read.csv(folder)
    assert written.count() == inputs.sales_lines(spark, tables).count() > 500
    assert written.where("order_year IS NULL").count() > 0 and written.select("order_year").distinct().count() > 64


def test_settings_return_after_an_error(spark):
    before = {name: spark.conf.get(name) for name in without_sorts(spark)}
    with pytest.raises(ZeroDivisionError), settings(spark, without_sorts(spark)):
        assert all(spark.conf.get(name) != value for name, value in before.items())
        raise ZeroDivisionError
    assert {name: spark.conf.get(name) for name in before} == before
