import uuid

import pytest

from lakewarden.operators.sync import SyncConfig
from lakewarden.plans.sync import sync_catalog
from lakewarden.schemas import CATALOG_SCHEMA
from lakewarden.session import new_folder
from lakewarden.sinks import register
from lakewarden.sinks.register import register_tables, unregister_tables
from lakewarden.sources.catalog import registered_tables, registered_targets

CONFIG = SyncConfig(
    "gold",
    ("dwh",),
    table_types=("EXTERNAL",),
    table_format="PARQUET",
    object_urls_only=False,
    fold_case=True,
)


@pytest.fixture
def database(spark):
    name = f"db_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{new_folder(spark, 'database')}'")
    return name


@pytest.fixture
def lake(spark, tmp_path):
    for i, name in enumerate(["first", "second"]):
        spark.range(i + 1).write.parquet(str(tmp_path / name))
    return tmp_path


def catalog(spark, lake, *names, missing=()):
    rows = [("gold", "dwh", name, "EXTERNAL", "PARQUET", str(lake / name)) for name in [*names, *missing]]
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def run(spark, source, database, **options):
    return sync_catalog(spark, source, registered_targets(spark, database), CONFIG, database, **options)


def names(spark, database):
    return {row.target for row in registered_targets(spark, database).collect()}


def test_registering_is_zero_copy_and_repeatable(spark, database, lake):
    source = catalog(spark, lake, "first", "second")
    result = run(spark, source, database)
    assert result.counters.first().asDict() == {"created": 2, "skipped": 0, "failed": 0, "deleted": 0}
    assert spark.table(f"{database}.uc_gold_dwh_second").count() == 2
    spark.range(10).write.mode("append").parquet(str(lake / "first"))
    spark.catalog.refreshTable(f"{database}.uc_gold_dwh_first")
    assert spark.table(f"{database}.uc_gold_dwh_first").count() == 11

    again = run(spark, source, database)
    assert {row.operation for row in again.plan.collect()} == {"skip"}
    assert again.counters.first().asDict() == {"created": 0, "skipped": 2, "failed": 0, "deleted": 0}


def test_dropping_keeps_the_data(spark, database, lake):
    run(spark, catalog(spark, lake, "first", "second"), database)
    kept = run(spark, catalog(spark, lake, "first"), database, delete_orphans=False)
    assert kept.counters.first()["deleted"] == 0
    assert names(spark, database) == {"uc_gold_dwh_first", "uc_gold_dwh_second"}
    result = run(spark, catalog(spark, lake, "first"), database)
    assert result.counters.first().asDict() == {"created": 0, "skipped": 1, "failed": 0, "deleted": 1}
    assert names(spark, database) == {"uc_gold_dwh_first"}
    assert spark.read.parquet(str(lake / "second")).count() == 2


def test_managed_and_foreign_tables_survive(spark, database, lake):
    spark.sql(f"CREATE TABLE {database}.uc_gold_dwh_managed (id INT) USING parquet")
    spark.sql(f"CREATE TABLE {database}.ucla_x (id INT) USING parquet LOCATION '{lake}/ucla'")
    result = run(spark, catalog(spark, lake, "first"), database)
    outcomes = {row.target: (row.operation, row.outcome) for row in result.outcomes.collect()}
    assert outcomes == {"uc_gold_dwh_managed": ("delete", "failed"), "uc_gold_dwh_first": ("create", "created")}
    assert names(spark, database) == {"uc_gold_dwh_managed", "ucla_x", "uc_gold_dwh_first"}


def test_mixed_case_names_settle(spark, database, lake):
    spark.range(4).write.parquet(str(lake / "MixedCase"))
    source = catalog(spark, lake, "MixedCase")
    assert run(spark, source, database).counters.first()["created"] == 1
    assert run(spark, source, database).counters.first().asDict() == {"created": 0, "skipped": 1, "failed": 0, "deleted": 0}


def test_a_failed_registration_does_not_stop_the_rest(spark, database, lake):
    # No data at one location, and a name the session catalog does not allow.
    source = catalog(spark, lake, "first", "second", missing=("nowhere", "odd name"))
    result = run(spark, source, database)
    assert result.counters.first().asDict() == {"created": 2, "skipped": 0, "failed": 2, "deleted": 0}
    messages = {row.target: row.message for row in result.outcomes.where("outcome = 'failed'").collect()}
    assert all(messages.values()) and set(messages) == {"uc_gold_dwh_nowhere", "uc_gold_dwh_odd name"}


def test_a_missing_listing_deletes_nothing(spark, database, lake):
    run(spark, catalog(spark, lake, "first"), database)
    with pytest.raises(ValueError, match="dwh"):
        run(spark, catalog(spark, lake), database)
    assert names(spark, database) == {"uc_gold_dwh_first"}
    assert run(spark, catalog(spark, lake), database, delete_orphans=False).counters.first()["deleted"] == 0
    emptied = run(spark, catalog(spark, lake), database, allow_empty_schemas=True)
    assert emptied.counters.first()["deleted"] == 1


def test_applying_a_stale_plan(spark, database, lake):
    source = catalog(spark, lake, "first")
    first = run(spark, source, database)
    again = {row.target: row.outcome for row in register_tables(spark, first.plan, database).collect()}
    assert again == {"uc_gold_dwh_first": "skipped"}
    gone = first.plan.selectExpr("concat(target, '_x') AS target", "'delete' AS operation")
    assert [row.outcome for row in unregister_tables(spark, gone, database).collect()] == ["already_absent"]


def test_a_repeated_source_row_registers_once(spark, database, lake):
    result = run(spark, catalog(spark, lake, "first", "first", "first"), database)
    assert result.counters.first().asDict() == {"created": 1, "skipped": 2, "failed": 0, "deleted": 0}


@pytest.mark.parametrize(("in_flight", "chunk"), [(1, 1), (8, 3), (4, 10_000)])
def test_outcomes_do_not_depend_on_statements_in_flight(spark, tmp_path, in_flight, chunk):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    database = f"flight_{in_flight}_{chunk}"
    spark.sql(f"CREATE DATABASE {database}")
    rows = [(f"n{i}", "create", None, str(tmp_path / "t"), "PARQUET") for i in range(10)] + [("s", "skip", "why", None, None)]
    planned = spark.createDataFrame(rows, "target string, operation string, reason string, storage_location string, data_source_format string")
    done = register_tables(spark, planned, database, in_flight, chunk)
    assert sorted((r["target"], r["outcome"]) for r in done.collect()) == sorted([(f"n{i}", "created") for i in range(10)] + [("s", "skipped")])
    gone = planned.selectExpr("target", "'delete' AS operation")
    done = unregister_tables(spark, gone, database, in_flight, chunk)
    assert sorted((r["target"], r["outcome"]) for r in done.collect()) == sorted([(f"n{i}", "deleted") for i in range(10)] + [("s", "already_absent")])
    spark.sql(f"DROP DATABASE {database}")


def _registered(spark, database):
    return {r.target: (r.catalog_name, r.schema_name) for r in registered_tables(spark, database).collect()}


def test_owners_decide_what_is_deleted(spark, database, lake):
    def rows(*entries):
        return spark.createDataFrame([("gold", s, n, "EXTERNAL", "PARQUET", str(lake / "first")) for s, n in entries], CATALOG_SCHEMA)

    both = SyncConfig("gold", ("a", "a_b"), ("EXTERNAL",), "PARQUET", object_urls_only=False, fold_case=True)
    only_a = SyncConfig("gold", ("a",), ("EXTERNAL",), "PARQUET", object_urls_only=False, fold_case=True)
    sync_catalog(spark, rows(("a", "x"), ("a", "y"), ("a_b", "z")), registered_tables(spark, database), both, database)
    spark.sql(f"CREATE TABLE {database}.uc_gold_a_stranger USING parquet LOCATION '{lake / 'second'}'")
    assert _registered(spark, database) == {
        "uc_gold_a_x": ("gold", "a"),
        "uc_gold_a_y": ("gold", "a"),
        "uc_gold_a_b_z": ("gold", "a_b"),
        "uc_gold_a_stranger": (None, None),
    }
    result = sync_catalog(spark, rows(("a", "x")), registered_tables(spark, database), only_a, database)
    planned = {r.target: (r.operation, r.reason) for r in result.plan.collect()}
    assert planned == {
        "uc_gold_a_x": ("skip", "exists"),
        "uc_gold_a_y": ("delete", "gone"),
        "uc_gold_a_stranger": ("skip", "unknown owner"),
    }
    assert names(spark, database) == {"uc_gold_a_x", "uc_gold_a_b_z", "uc_gold_a_stranger"}


def test_odd_owner_names_survive(spark, database, lake):
    odd = "it's, a=b] \\ ü"
    source = spark.createDataFrame([("gold", odd, "t", "EXTERNAL", "PARQUET", str(lake / "first"))], CATALOG_SCHEMA)
    planned = source.selectExpr("'odd' AS target", "'create' AS operation", "'new' AS reason", "*")
    assert [r.outcome for r in register_tables(spark, planned, database).collect()] == ["created"]
    assert _registered(spark, database) == {"odd": ("gold", odd)}


def test_a_run_that_broke_off_goes_on(spark, database, lake, monkeypatch):
    many = [("gold", "dwh", f"t{i}", "EXTERNAL", "PARQUET", str(lake / "first")) for i in range(6)]
    source = spark.createDataFrame(many, CATALOG_SCHEMA)
    attempted = []
    create = register._create

    def stopping(spark, database, row):
        if len(attempted) == 4 and not resumed:
            raise KeyboardInterrupt
        attempted.append(row.target)
        return create(spark, database, row)

    resumed = False
    monkeypatch.setattr(register, "_create", stopping)
    plan_id = uuid.uuid4().hex
    options = {"plan_id": plan_id, "chunk": 2}
    with pytest.raises(KeyboardInterrupt):
        run(spark, source, database, **options)
    assert len(names(spark, database)) == 4
    resumed = True
    result = run(spark, source, database, **options)
    assert sorted(attempted) == [f"uc_gold_dwh_t{i}" for i in range(6)]
    assert result.counters.first().asDict() == {"created": 6, "skipped": 0, "failed": 0, "deleted": 0}
    assert result.plan_id == plan_id
