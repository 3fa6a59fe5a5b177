"""Inputs of the registered queries, derived from the given tables.

Every derivation keeps all rows of its tables, so the work of a query grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewarden.functions.paths import (
    leading_parts,
    parent_path,
    path_depth,
    strip_trailing_slash,
)
from lakewarden.functions.registration import (
    ACCESS_DENIED_TEXT,
    ALREADY_REGISTERED_MESSAGE,
    target_name,
)
from lakewarden.operators.sync import SyncConfig
from lakewarden.session import new_folder, settings, without_sorts

CATALOG_NAME = "gold_dev"


def schemas(spark: SparkSession, sf_dir: str) -> tuple[str, ...]:
    """The schemas of the source catalog, one per brand."""
    names = table(spark, sf_dir, "part").select(_schema_name().alias("name")).where("name IS NOT NULL").distinct()
    return tuple(sorted(row.name for row in names.collect()))


def config(spark: SparkSession, sf_dir: str) -> SyncConfig:
    """All schemas of the source catalog are managed."""
    return SyncConfig(catalog=CATALOG_NAME, schemas=schemas(spark, sf_dir), connection_id="connection-1")


def _schema_name() -> Column:
    return F.lower(F.replace("p_brand", F.lit("#")))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _money(amount: str) -> Column:
    return F.col(amount).cast("decimal(18,2)").cast("string")


def sales_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nine text columns of an order file, with the year of the order, dealt by year.

    Orders meet their customers before the lines do, so the lines are shuffled once less. Rebalancing
    lets adaptive execution give a large year several files and small years one; it moves the columns
    as the tables hold them, which are a third of the texts made of them.
    """
    placed = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    joined = (
        table(spark, sf_dir, "lineitem")
        .join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    )
    dealt = joined.select(
        "o_orderkey",
        "l_linenumber",
        "o_orderdate",
        "c_name",
        "p_name",
        "l_quantity",
        "p_retailprice",
        "l_tax",
        F.year("o_orderdate").alias("order_year"),
    ).hint("rebalance", "order_year")
    return dealt.select(
        F.col("o_orderkey").cast("string").alias("SalesOrderNumber"),
        F.col("l_linenumber").cast("string").alias("SalesOrderLineNumber"),
        F.col("o_orderdate").cast("date").cast("string").alias("OrderDate"),
        F.col("c_name").alias("CustomerName"),
        F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com")).alias("Email"),
        F.col("p_name").alias("Item"),
        F.col("l_quantity").cast("int").cast("string").alias("Quantity"),
        _money("p_retailprice").alias("UnitPrice"),
        _money("l_tax").alias("Tax"),
        "order_year",
    )


_landed: dict[tuple[str, str], str] = {}


def landed_sales(spark: SparkSession, sf_dir: str) -> str:
    """Folder of headerless order files, one subfolder per order year; written once per application."""
    key = (spark.conf.get("spark.app.id"), sf_dir)
    if key not in _landed:
        folder = new_folder(spark, "orders")
        with settings(spark, without_sorts(spark)):
            sales_lines(spark, sf_dir).write.partitionBy("order_year").csv(folder)
        _landed[key] = folder
    return _landed[key]


def headed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a file with a header line would hold them."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"),
        F.col("o_orderdate").cast("date").alias("o_orderdate"),
        "o_orderpriority",
        (F.col("o_orderstatus") == "O").alias("is_open"),
    )


def _page_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    without_scheme = F.regexp_replace("url", "^[a-z]+://", "")
    raw = F.regexp_replace(without_scheme, "[?#].*$", "")
    return table(spark, sf_dir, "pages").select("page_id", "url", "html", raw.alias("raw"))


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as stored objects. A page whose path ends in ``/`` is a folder; so is each path above a page."""
    entries = _page_paths(spark, sf_dir).select(
        strip_trailing_slash(F.col("raw")).alias("path"),
        F.col("raw").endswith("/").alias("is_dir"),
        F.octet_length("html").cast("bigint").alias("length"),
    )
    modified = F.lit("2024-01-01 00:00:00").cast("timestamp").alias("modified")
    files = entries.where(~F.col("is_dir")).select("path", "is_dir", "length", modified)
    nearest = F.when(F.col("is_dir"), F.col("path")).otherwise(parent_path(F.col("path")))
    folders = (
        entries.select(nearest.alias("folder"))
        .where(F.col("folder").isNotNull())
        .distinct()
        .select("folder", F.explode(F.sequence(F.lit(1), path_depth(F.col("folder")))).alias("depth"))
        .select(leading_parts(F.col("folder"), F.col("depth")).alias("path"))
        .distinct()
    )
    zero = F.lit(0).cast("bigint").alias("length")
    return files.unionByName(folders.select("path", F.lit(True).alias("is_dir"), zero, modified))


def existence_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every page its own path and a path that may not exist."""
    path = strip_trailing_slash(F.col("raw"))
    wanted = F.array(path, F.concat(path, F.lit("/index.html")))
    return _page_paths(spark, sf_dir).select("page_id", F.explode(wanted).alias("path"))


def storage_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page addresses as storage URLs; those of secure pages lack the container part."""
    start = F.when(F.col("url").startswith("https:"), F.lit("abfss://")).otherwise(F.lit("abfss://web@"))
    return _page_paths(spark, sf_dir).select("page_id", "raw", F.concat(start, "raw").alias("path"))


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source table per part."""
    schema = _schema_name()
    name = F.concat(F.lit("part_"), F.col("p_partkey").cast("string"))
    return table(spark, sf_dir, "part").select(
        F.lit(CATALOG_NAME).alias("catalog_name"),
        schema.alias("schema_name"),
        name.alias("name"),
        F.when(F.col("p_partkey") % 5 < 3, "MANAGED").otherwise("EXTERNAL").alias("table_type"),
        F.when(F.col("p_partkey") % 11 == 0, "CSV").otherwise("DELTA").alias("data_source_format"),
        F.concat(F.lit("abfss://gold@acct.dfs.core.windows.net/"), schema, F.lit("/"), name).alias("storage_location"),
    )


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One registered name per part: current, outdated, of another catalog, or not managed at all."""
    schema = _schema_name()
    name = F.concat(F.lit("part_"), F.col("p_partkey").cast("string"))
    old_name = F.concat(F.lit("old_"), name)
    size = F.col("p_size")
    target = (
        F.when(size <= 15, target_name(F.lit(CATALOG_NAME), schema, name))
        .when(size <= 25, target_name(F.lit(CATALOG_NAME), schema, old_name))
        .when(size <= 30, target_name(F.lit("silver_dev"), schema, name))
        .when(size <= 35, F.concat(F.lit("ucla_"), name))
        .otherwise(F.concat(F.lit("archive_"), name))
    )
    return table(spark, sf_dir, "part").select(target.alias("target"))


def owned_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``targets`` with their owners: outdated names belong to their schema, to a schema that begins like it, or to nobody known."""
    schema, key, size = _schema_name(), F.col("p_partkey"), F.col("p_size")
    outdated = size.between(16, 25)
    owner = F.when(outdated & (key % 3 == 1), F.concat(schema, F.lit("_old"))).when(~outdated | (key % 3 == 0), schema)
    name = F.concat(F.lit("part_"), key.cast("string"))
    target = (
        F.when(size <= 15, target_name(F.lit(CATALOG_NAME), schema, name))
        .when(outdated, target_name(F.lit(CATALOG_NAME), schema, F.concat(F.lit("old_"), name)))
        .otherwise(target_name(F.lit("silver_dev"), schema, name))
    )
    catalog_name = F.when(size > 25, "silver_dev").otherwise(CATALOG_NAME)
    return table(spark, sf_dir, "part").select(target.alias("target"), catalog_name.alias("catalog_name"), owner.alias("schema_name"))


def page_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An object per page below a folder per address, some empty, some hidden; a folder alone for addresses that end in a slash."""
    number = F.col("page_id").cast("string")
    folder = strip_trailing_slash(F.col("raw"))
    hidden = F.when(F.col("page_id") % 3 == 0, "_").otherwise("")
    content = F.when(F.col("page_id") % 7 == 0, "").otherwise(F.col("html"))
    pages = _page_paths(spark, sf_dir).select("page_id", "raw").join(table(spark, sf_dir, "pages").select("page_id", "html"), "page_id")
    is_folder = F.col("raw").endswith("/")
    path = F.when(is_folder, F.concat(folder, F.lit("/only_"), number)).otherwise(F.concat(folder, F.lit("/"), hidden, F.lit("page_"), number))
    return pages.select(path.alias("path"), F.when(~is_folder, content.cast("binary")).alias("content"))


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One recorded create attempt per event."""
    item = F.get_json_object("props", "$.k")
    kind = item.cast("int") % 3
    target = F.concat(F.lit("uc_"), F.col("user_id").cast("string"), F.lit("_"), item)
    message = (
        F.when(kind == 0, F.lit(ALREADY_REGISTERED_MESSAGE))
        .when(kind == 1, F.concat(F.lit(ACCESS_DENIED_TEXT), F.lit(" was refused")))
        .otherwise(F.lit("Target path not found"))
    )
    status = (
        F.when(F.col("event_type") == "view", 201)
        .when(F.col("event_type") == "click", 400)
        .when(F.col("event_type") == "error", 403)
        .when(F.col("event_type") == "purchase", 429)
        .otherwise(500)
    )
    rejection = F.to_json(F.struct(F.array(F.struct(message.alias("message"))).alias("moreDetails")))
    body = F.when(status == 400, rejection).when(status == 201, F.to_json(F.struct(target.alias("name"))))
    return table(spark, sf_dir, "events").select(
        target.alias("target"),
        F.col("event_id").alias("attempt"),
        status.alias("http_status"),
        body.alias("body"),
    )


def removals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One recorded attempt to remove a registration per event."""
    kind = F.col("event_type")
    status = F.when(kind == "view", 200).when(kind == "click", 404).when(kind == "purchase", 429).otherwise(500)
    target = F.concat(F.lit("uc_old_"), F.col("event_id").cast("string"))
    return table(spark, sf_dir, "events").select(target.alias("target"), status.alias("http_status"))
