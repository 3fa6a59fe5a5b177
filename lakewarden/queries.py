"""The registered queries: each operator over the given tables, whole."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewarden import inputs
from lakewarden.functions import paths
from lakewarden.inputs import CATALOG_NAME, table
from lakewarden.operators import inventory as inv
from lakewarden.operators import report, sync
from lakewarden.operators.sync import SyncConfig
from lakewarden.plans.housekeeping import directory_sizes, find_empty_folders
from lakewarden.plans.ingest import ingest_files, ingest_orders, load_csv, preview
from lakewarden.plans.sync import SyncResult, plan_sync, sync_catalog
from lakewarden.schemas import ORDER_SCHEMA
from lakewarden.session import new_folder
from lakewarden.sinks.objects import copy_objects, put_objects
from lakewarden.sinks.tables import append_table, copy_dataset, overwrite_table, replace_registered
from lakewarden.sources.catalog import catalog_snapshot, registered_tables, table_rows
from lakewarden.sources.files import PIECE_BYTES, scan_binary, scan_objects
from lakewarden.sources.inventory import inventory as read_inventory
from lakewarden.sources.inventory import list_files, names_in_folder
from lakewarden.sources.tree import list_tree
from lakewarden.streaming.arrivals import ingest_new_files

Query = Callable[[SparkSession, str], DataFrame]


# Delimited files into tables


def csv_declared_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = inputs.landed_sales(spark, sf_dir)
    return ingest_orders(spark, landed, new_folder(spark, "orders-table"))


def csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = new_folder(spark, "headed"), new_folder(spark, "headed-table")
    inputs.headed_orders(spark, sf_dir).write.csv(source, header=True)
    load_csv(spark, source, target, mode="overwrite")
    return spark.read.parquet(target).select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
        "o_totalprice",
        F.col("o_orderdate").cast("string").alias("o_orderdate"),
        "o_orderpriority",
        "is_open",
    )


def ingest_many_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = inputs.landed_sales(spark, sf_dir)
    loaded = ingest_files(spark, landed, new_folder(spark, "many"), ORDER_SCHEMA, lineage=True)
    year = F.regexp_extract("source_file", "order_year=([0-9]+)/", 1).cast("bigint")
    return loaded.groupBy(year.alias("order_year")).agg(F.count("*").alias("n_rows"))


def ingest_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arriving files in a table that has rows already: one per customer."""
    landed = inputs.landed_sales(spark, sf_dir)
    target, ledger = new_folder(spark, "arrivals"), new_folder(spark, "arrivals-ledger")
    known = {"CustomerName": F.col("c_name"), "Item": F.col("c_mktsegment")}
    columns = [known.get(name, F.lit(None)).cast("string").alias(name) for name in ORDER_SCHEMA.names]
    append_table(table(spark, sf_dir, "customer").select(*columns), target)
    for _ in range(2):
        ingest_new_files(spark, landed, target, ORDER_SCHEMA, ledger)
    return spark.read.parquet(target)


def append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = new_folder(spark, "append")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    recent = F.coalesce(F.col("o_orderdate") >= F.lit("1998-01-01").cast("date"), F.lit(False))
    append_table(orders.where(~recent), target)
    append_table(orders.where(recent), target)
    return spark.read.parquet(target).select("o_orderkey", "o_orderstatus")


def overwrite_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = new_folder(spark, "overwrite")
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS id", "o_orderpriority AS label")
    customers = table(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "c_mktsegment AS label")
    overwrite_table(orders, target)
    overwrite_table(customers, target)
    return spark.read.parquet(target)


def preview_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return preview(orders.orderBy("o_orderkey"))


def copied_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = new_folder(spark, "copy")
    copy_dataset(spark, f"{sf_dir}/lineitem.parquet", target)
    return spark.read.parquet(target).withColumn("l_shipdate", F.col("l_shipdate").cast("date").cast("string"))


def copy_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A copy of a dataset in folders by year and flag, whose layout and text of folder names stay."""
    source, target = new_folder(spark, "by-year"), new_folder(spark, "by-year-copy")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", F.year("l_shipdate").alias("year"))
    lines.hint("rebalance", "year").write.partitionBy("year", "l_returnflag").parquet(source)
    copy_dataset(spark, source, target)
    copied = spark.read.parquet(target).withColumn("folder", F.regexp_extract("_metadata.file_path", "year=([0-9]+/l_returnflag=[A-Z])/", 1))
    return copied.select("l_orderkey", "l_linenumber", "l_quantity", "folder")


def copy_mixed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A copy of files that differ in columns."""
    source, target = new_folder(spark, "mixed"), new_folder(spark, "mixed-copy")
    orders = table(spark, sf_dir, "orders")
    is_final = F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))
    orders.where(is_final).select("o_orderkey", "o_custkey").write.parquet(source)
    orders.where(~is_final).select("o_orderkey", "o_orderpriority").write.mode("append").parquet(source)
    copy_dataset(spark, source, target)
    return spark.read.option("mergeSchema", True).parquet(target).select("o_orderkey", "o_custkey", "o_orderpriority")


def copy_objects_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order files copied byte for byte and read back: bytes and lines per year."""
    target = new_folder(spark, "copied-files")
    copy_objects(spark, inputs.landed_sales(spark, sf_dir), target)
    objects = scan_objects(spark, target, F.col("path").endswith(".csv"), PIECE_BYTES)
    year = F.regexp_extract("path", "order_year=([0-9]+)/", 1).cast("bigint").alias("order_year")
    lines = F.regexp_count(F.decode("content", "UTF-8"), F.lit("\n")).alias("n_lines")
    counted = objects.select(year, F.octet_length("content").alias("n_bytes"), lines)
    return counted.groupBy("order_year").agg(F.sum("n_bytes").alias("n_bytes"), F.sum("n_lines").alias("n_lines"))


def load_csv_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two headed files appended one after the other; the second is read under the table's columns."""
    target = new_folder(spark, "appended-csv")
    orders = inputs.headed_orders(spark, sf_dir)
    is_open = F.coalesce(F.col("is_open"), F.lit(False))
    for part in (orders.where(is_open), orders.where(~is_open)):
        source = new_folder(spark, "headed")
        part.write.csv(source, header=True)
        load_csv(spark, source, target, mode="append")
    return spark.read.parquet(target).select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "o_orderpriority", "is_open")


def replaced_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registered table whose rows were replaced by pointing it at new ones."""
    name = f"lakewarden_{uuid.uuid4().hex}"
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS id", "o_orderpriority AS label")
    customers = table(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "c_mktsegment AS label")
    orders.write.parquet(first := new_folder(spark, "first"))
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{first}'")
    replace_registered(customers, name, new_folder(spark, "next"))
    return spark.table(name)


def binary_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and lines per year of the order files, read in pieces, since files grow with the tables."""
    objects = scan_binary(spark, inputs.landed_sales(spark, sf_dir), "*.csv", PIECE_BYTES)
    return (
        objects.select(
            F.regexp_extract("path", "order_year=([0-9]+)/", 1).cast("bigint").alias("order_year"),
            F.octet_length("content").alias("n_bytes"),
            F.regexp_count(F.decode("content", "UTF-8"), F.lit("\n")).alias("n_lines"),
        )
        .groupBy("order_year")
        .agg(F.sum("n_bytes").alias("n_bytes"), F.sum("n_lines").alias("n_lines"))
    )


# Paths


def path_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.col("path")
    parsed = inputs.storage_paths(spark, sf_dir).select(
        "page_id",
        paths.split_path_to_parts(path).alias("parts"),
        paths.location_to_https(path).alias("https"),
        F.array_join(paths.path_parts(path), "|").alias("components"),
    )
    return parsed.select(
        "page_id",
        F.col("parts.container").alias("container"),
        F.col("parts.directory").alias("directory"),
        F.col("parts.url").alias("url"),
        F.col("https.account").alias("account"),
        F.col("https.subpath").alias("subpath"),
        F.col("https.https").alias("https"),
        "components",
    )


def path_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = inputs.storage_paths(spark, sf_dir)
    account = F.substring_index("raw", ".", 1)
    container = F.split_part("raw", F.lit("/"), F.lit(2))
    base = paths.abfss_url(container, account)
    return raw.select("page_id", base.alias("base"), paths.join_path(base, F.col("raw")).alias("path"))


def path_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = inputs.inventory(spark, sf_dir)
    depth = inv.max_depth(listing).first()["max_depth"]
    levels = paths.with_path_levels(listing.select("path", "is_dir"), depth)
    return inv.sort_by_levels(levels, depth)


# Storage inventory


def inventory_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    export = new_folder(spark, "inventory")
    inputs.inventory(spark, sf_dir).write.json(export)
    return read_inventory(spark, export, fmt="json").select("path", "is_dir", "length")


def inventory_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = list_files(spark, inputs.landed_sales(spark, sf_dir), glob="*.csv")
    return inv.top_level_sizes(listing)


def dir_size_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inv.top_level_sizes(inputs.inventory(spark, sf_dir))


def dir_size_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inv.directory_size(inputs.inventory(spark, sf_dir), "", unit="GB")


def dir_size_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return directory_sizes(inputs.inventory(spark, sf_dir), unit="MB")


def max_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inv.max_depth(inputs.inventory(spark, sf_dir))


def level_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inv.level_stats(inputs.inventory(spark, sf_dir))


def level_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inv.level_values(inputs.inventory(spark, sf_dir))


def folder_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inv.mark_empty_folders(inputs.inventory(spark, sf_dir))


def empty_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_empty_folders(inputs.inventory(spark, sf_dir))


def dir_size_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes below one folder: the first of the root by name."""
    listing = inputs.inventory(spark, sf_dir)
    return inv.directory_size(listing, _first_folder(listing), unit="MB")


def empty_folders_below(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = inputs.inventory(spark, sf_dir)
    return find_empty_folders(listing, root=_first_folder(listing))


def _first_folder(listing: DataFrame) -> str:
    return listing.agg(F.min(F.substring_index("path", "/", 1))).first()[0] or ""


def inventory_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree with empty folders, empty objects and hidden names, listed as it stands."""
    root = new_folder(spark, "pages")
    put_objects(inputs.page_objects(spark, sf_dir), root)
    return list_tree(spark, root).select("path", "is_dir", "length")


def exists_probe_few(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inv.probe_existence(inputs.existence_requests(spark, sf_dir), inputs.inventory(spark, sf_dir))


def exists_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Two requests per page: they outnumber the objects.
    requests = inputs.existence_requests(spark, sf_dir)
    return inv.probe_existence(requests, inputs.inventory(spark, sf_dir), few_requests=False)


# Catalog and registrations


def catalog_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    export = new_folder(spark, "catalog")
    inputs.catalog(spark, sf_dir).write.json(export)
    return catalog_snapshot(spark, export, inputs.config(spark, sf_dir))


def union_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One listing per schema, each in a folder of its own, all of them read in one scan."""
    export = new_folder(spark, "listings")
    rows = inputs.catalog(spark, sf_dir).withColumn("listing", F.col("schema_name"))
    rows.hint("rebalance", "listing").write.partitionBy("listing").json(export)
    listings = sync.union_partitions(catalog_snapshot(spark, export), inputs.config(spark, sf_dir), "listing")
    return listings.select("schema_name", "name", "table_type")


def schema_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some schemas of one of two catalogs."""
    gold = inputs.catalog(spark, sf_dir)
    exported = new_folder(spark, "catalogs")
    gold.unionByName(gold.withColumn("catalog_name", F.lit("silver_dev"))).write.json(exported)
    chosen = tuple(name for name in inputs.schemas(spark, sf_dir) if name.endswith(("1", "3")))
    return catalog_snapshot(spark, exported, SyncConfig("silver_dev", chosen)).select("catalog_name", "schema_name", "name")


def targets_in_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names_in_folder(inputs.inventory(spark, sf_dir), "")


def _sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = inputs.config(spark, sf_dir)
    return sync.compose_targets(sync.select_schemas(inputs.catalog(spark, sf_dir), config), config)


def _targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sync.owned_targets(inputs.targets(spark, sf_dir), inputs.config(spark, sf_dir))


def sync_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sync.still_present(_targets(spark, sf_dir), _sources(spark, sf_dir))


def sync_deletions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sync.to_delete(_targets(spark, sf_dir), _sources(spark, sf_dir))


def sync_creations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sync.to_create(_sources(spark, sf_dir), _targets(spark, sf_dir)).select("target")


def sync_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sync.diff(_sources(spark, sf_dir), _targets(spark, sf_dir))


def sync_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = plan_sync(inputs.catalog(spark, sf_dir), inputs.targets(spark, sf_dir), inputs.config(spark, sf_dir))
    return planned.select("target", "operation", "reason", "location", "subpath", "payload")


def sync_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan against names that tell their owners: other schemas' names and those of nobody known stay."""
    planned = plan_sync(inputs.catalog(spark, sf_dir), inputs.owned_names(spark, sf_dir), inputs.config(spark, sf_dir))
    return planned.select("target", "operation", "reason")


def sync_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two schemas whose tables compose the same names, some of them registered already."""
    catalog, schemas = inputs.catalog(spark, sf_dir), inputs.schemas(spark, sf_dir)
    longer = catalog.withColumn("schema_name", F.concat("schema_name", F.lit("_part")))
    longer = longer.withColumn("name", F.substr("name", F.lit(len("part_") + 1)))
    config = SyncConfig(CATALOG_NAME, (*schemas, *[f"{name}_part" for name in schemas]))
    planned = plan_sync(catalog.unionByName(longer), inputs.targets(spark, sf_dir), config)
    return planned.select("target", "schema_name", "operation", "reason")


def sync_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.count_by(sync_plan(spark, sf_dir), "operation")


def attempt_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.with_outcome(inputs.attempts(spark, sf_dir))


def attempt_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.count_by(attempt_classes(spark, sf_dir), "outcome")


def removal_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.count_by(report.with_removal_outcome(inputs.removals(spark, sf_dir)), "outcome")


def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    creations = report.final_outcomes(attempt_classes(spark, sf_dir)).select("target", "outcome")
    removals = report.with_removal_outcome(inputs.removals(spark, sf_dir)).select("target", "outcome")
    return report.run_counters(creations.unionByName(removals))


def _register_brands(spark: SparkSession, sf_dir: str) -> tuple[str, list[SyncResult]]:
    """A database in which a table per brand was registered and some of them withdrawn again; both runs."""
    lake = new_folder(spark, "lake")
    brand = F.lower(F.replace("p_brand", F.lit("#")))
    parts = table(spark, sf_dir, "part").withColumn("brand", brand)
    parts.hint("rebalance", "brand").write.partitionBy("brand").parquet(lake)

    database = f"lakewarden_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{new_folder(spark, 'database')}'")
    config = SyncConfig(
        CATALOG_NAME,
        inputs.schemas(spark, sf_dir),
        table_types=("EXTERNAL",),
        table_format="PARQUET",
        object_urls_only=False,
        fold_case=True,
    )
    brands = parts.select(
        F.lit(CATALOG_NAME).alias("catalog_name"),
        F.col("brand").alias("schema_name"),
        F.lit("part").alias("name"),
        F.lit("EXTERNAL").alias("table_type"),
        F.lit("PARQUET").alias("data_source_format"),
        F.concat(F.lit(f"{lake}/brand="), "brand").alias("storage_location"),
    ).distinct()
    remaining = brands.where(~F.col("schema_name").startswith("brand2"))
    runs = [
        sync_catalog(spark, snapshot, registered_tables(spark, database), config, database, allow_empty_schemas=True)
        for snapshot in (brands, remaining)
    ]
    return database, runs


def register_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per registered table after brands were registered and some of them withdrawn again."""
    database, _ = _register_brands(spark, sf_dir)
    return table_rows(spark, database)


def sync_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of two real runs."""
    _, (first, second) = _register_brands(spark, sf_dir)
    return first.counters.select(F.lit("first").alias("run"), "*").unionByName(second.counters.select(F.lit("second").alias("run"), "*"))


QUERIES: dict[str, Query] = {
    "csv_declared_roundtrip": csv_declared_roundtrip,
    "csv_inferred": csv_inferred,
    "ingest_many_files": ingest_many_files,
    "ingest_rerun": ingest_rerun,
    "append_twice": append_twice,
    "overwrite_last_wins": overwrite_last_wins,
    "preview_top5": preview_top5,
    "copy_dataset": copied_dataset,
    "binary_scan": binary_scan,
    "path_parse": path_parse,
    "path_build": path_build,
    "path_levels": path_levels,
    "inventory_export": inventory_export,
    "inventory_listing": inventory_listing,
    "dir_size_top": dir_size_top,
    "dir_size_root": dir_size_root,
    "dir_size_all": dir_size_all,
    "max_depth": max_depth,
    "level_stats": level_stats,
    "level_values": level_values,
    "folder_flags": folder_flags,
    "empty_folders": empty_folders,
    "exists_probe": exists_probe,
    "catalog_snapshot": catalog_listing,
    "union_schemas": union_schemas,
    "targets_in_folder": targets_in_folder,
    "sync_semi": sync_semi,
    "sync_deletions": sync_deletions,
    "sync_creations": sync_creations,
    "sync_diff": sync_diff,
    "sync_plan": sync_plan,
    "sync_report": sync_report,
    "attempt_classes": attempt_classes,
    "attempt_outcomes": attempt_outcomes,
    "removal_outcomes": removal_outcomes,
    "run_counters": run_counters,
    "register_roundtrip": register_roundtrip,
    "load_csv_append": load_csv_append,
    "replace_registered": replaced_table,
    "copy_partitioned": copy_partitioned,
    "copy_mixed_columns": copy_mixed_columns,
    "copy_objects": copy_objects_whole,
    "inventory_live": inventory_live,
    "dir_size_folder": dir_size_folder,
    "empty_folders_below": empty_folders_below,
    "exists_probe_few": exists_probe_few,
    "schema_selection": schema_selection,
    "sync_ownership": sync_ownership,
    "sync_conflicts": sync_conflicts,
    "sync_outcomes": sync_outcomes,
}
