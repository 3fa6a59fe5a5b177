"""Shape of the physical plans, and balance when one key dominates."""

import re

import pytest
from pyspark.sql import functions as F

from lakewarden.operators import inventory as inv
from lakewarden.operators import matching, report, sync
from lakewarden.queries import QUERIES
from tests.helpers import final_plan_text, plan_text

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    saved = {}

    def apply(**options):
        for key, value in options.items():
            key = key.replace("__", ".")
            saved.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield apply
    for key, value in saved.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def eager_skew_split(conf):
    conf(
        spark__sql__shuffle__partitions="32",
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64k",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64k",
    )


def hot_rows(spark, n=200_000):
    """A third of the rows share one key; the others are all different."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id")))
    return spark.range(0, n, 1, 8).select(key.alias("target"), F.sha2(F.col("id").cast("string"), 256).alias("load"))


LAZY = [
    "dir_size_all", "dir_size_root", "dir_size_top", "empty_folders", "exists_probe", "folder_flags", "level_stats",
    "level_values", "max_depth", "path_build", "path_parse", "sync_creations", "sync_deletions", "sync_diff",
    "sync_plan", "sync_report", "sync_semi", "attempt_classes", "attempt_outcomes",
    "removal_outcomes", "run_counters",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_pairwise_joins(spark, name):
    plan = plan_text(QUERIES[name](spark, SF_DIR))
    for operator in ("Python", "InPandas", "CartesianProduct", "NestedLoopJoin", "ObjectHashAggregate", "SortAggregate"):
        assert operator not in plan


def test_reports_without_sizes_do_not_read_page_bodies(spark):
    for name in ("empty_folders", "folder_flags", "level_values", "exists_probe"):
        plan = plan_text(QUERIES[name](spark, SF_DIR))
        assert "html:string" not in plan
    assert "html:string" in plan_text(QUERIES["dir_size_all"](spark, SF_DIR))


def test_folder_filter_reaches_the_scan(spark, tmp_path):
    listing = spark.createDataFrame([("a/x", False, 1)], "path string, is_dir boolean, length bigint")
    listing.write.parquet(str(tmp_path / "inventory"))
    plan = plan_text(inv.directory_size(spark.read.parquet(str(tmp_path / "inventory")), "a"))
    assert "StringStartsWith(path,a/)" in plan


def test_sync_plan_shuffles_names_once(spark):
    plan = final_plan_text(QUERIES["sync_plan"](spark, SF_DIR))
    assert "ReusedExchange" in plan


@pytest.mark.parametrize("match", [matching.keep_matching, matching.drop_matching])
def test_hot_key_is_split_in_semi_and_anti_joins(spark, eager_skew_split, match):
    left = hot_rows(spark)
    right = left.select("target").union(left.select("target")).where("target != 'k1'")
    result = match(left, right, "target")
    assert "skew=true" in final_plan_text(result)
    expected = 1 if match is matching.drop_matching else 199_999
    assert result.count() == expected


@pytest.mark.parametrize("flagging", [matching.flag_matching, matching.flag_listed])
def test_hot_key_is_split_when_flagging(spark, eager_skew_split, flagging):
    left = hot_rows(spark)
    right = left.where("target = 'hot' OR target LIKE 'k%1'").select("target")
    result = flagging(left, right, "target", "found")
    assert re.search(r"SortMergeJoin\(skew=true\) [^\n]*LeftOuter", final_plan_text(result))
    found = {row.found: row["count"] for row in result.groupBy("found").count().collect()}
    assert found == {True: right.count(), False: 200_000 - right.count()}


def test_hot_name_is_split_in_the_sync_plan(spark, eager_skew_split):
    n = 120_000
    name = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("t"), F.col("id")))
    catalog = spark.range(0, n, 1, 8).select(
        F.lit("gold_dev").alias("catalog_name"),
        F.lit("brand1").alias("schema_name"),
        name.alias("name"),
        F.lit("MANAGED").alias("table_type"),
        F.lit("DELTA").alias("data_source_format"),
        F.concat(F.lit("abfss://c@acct/"), F.sha2(F.col("id").cast("string"), 256)).alias("storage_location"),
    )
    config = sync.SyncConfig("gold_dev", ("brand1",))
    sources = sync.compose_targets(catalog, config)
    targets = sources.where("name = 'hot'").select("target")
    result = sync.plan(sources, targets, config)
    assert "skew=true" in final_plan_text(result)
    assert dict(result.groupBy("operation").count().collect()) == {"create": 80_000, "skip": 40_000}


def test_hot_folder_reaches_the_shuffle_as_subtotals(spark, conf):
    # Eight tasks see a third of all files in one folder; each sends it as one row.
    conf(spark__sql__adaptive__enabled="false")
    n = 240_000
    path = F.when(F.col("id") % 3 == 0, F.lit("r/hot/")).otherwise(F.concat(F.lit("r/d"), F.col("id") % 50, F.lit("/")))
    listing = spark.range(0, n, 1, 8).select(
        F.concat(path, F.col("id")).alias("path"), F.lit(False).alias("is_dir"), F.lit(2).cast("bigint").alias("length")
    )
    result = inv.directory_sizes(listing)
    rows = {row.dir: row.bytes for row in result.collect()}
    assert rows["r"] == 2 * n and rows["r/hot"] == 2 * n // 3 and len(rows) == 52
    written = _shuffle_records(result)
    assert max(written) <= 8 * 52


def test_hot_target_reaches_the_shuffle_as_partial_rows(spark, conf):
    conf(spark__sql__adaptive__enabled="false")
    attempts = spark.range(0, 90_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.lit("cold")).alias("target"),
        F.col("id").alias("attempt"),
        F.lit("created").alias("outcome"),
    )
    result = report.final_outcomes(attempts)
    assert dict(result.collect()) == {"hot": "created", "cold": "created"}
    assert max(_shuffle_records(result)) <= 16


def test_few_requests_do_not_shuffle_the_listing(spark, conf, tmp_path):
    conf(spark__sql__adaptive__enabled="false")
    listing = spark.range(0, 100_000).select(F.concat(F.lit("a/f"), F.col("id")).alias("path"))
    listing.write.parquet(str(tmp_path / "listing"))
    spark.createDataFrame([("a/f1",), ("a/f2",), ("b",)], "path string").write.parquet(str(tmp_path / "requests"))
    requests = spark.read.parquet(str(tmp_path / "requests"))
    result = inv.probe_existence(requests, spark.read.parquet(str(tmp_path / "listing")))
    assert sorted(map(tuple, result.collect())) == [("a/f1", True), ("a/f2", True), ("b", False)]
    assert max(_shuffle_records(result)) <= 3


def _shuffle_records(df):
    """Records written by each shuffle of a query that has run."""
    found, pending = [], [df._jdf.queryExecution().executedPlan()]
    while pending:
        node = pending.pop()
        metric = node.metrics().get("shuffleRecordsWritten")
        if metric.isDefined():
            found.append(metric.get().value())
        children = node.children()
        pending.extend(children.apply(i) for i in range(children.size()))
    return found
