"""Table metadata of a source catalog and the names registered in a target database."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakewarden.operators.sync import SyncConfig, select_schemas
from lakewarden.schemas import CATALOG_PROPERTY, CATALOG_SCHEMA, LISTING_SCHEMA, SCHEMA_PROPERTY


def catalog_snapshot(
    spark: SparkSession,
    path: str | list[str],
    config: SyncConfig | None = None,
    layout: str = "rows",
) -> DataFrame:
    """Read exported table metadata, optionally only the configured schemas.

    ``layout="rows"`` expects one table per JSON line, which Spark can split however many tables one
    schema has. ``layout="responses"`` expects one listing response per JSON line, with the tables
    in an array. A malformed export is an error: planning on part of a catalog would delete
    registrations.
    """
    if layout not in ("rows", "responses"):
        raise ValueError(f"unknown layout {layout!r}")
    schema = CATALOG_SCHEMA if layout == "rows" else LISTING_SCHEMA
    tables = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    if layout == "responses":
        tables = tables.select(F.inline("tables"))
    for name in ("catalog_name", "schema_name", "name"):
        absent = F.raise_error(F.lit(f"a table of the catalog has no {name}")).cast("string")
        tables = tables.withColumn(name, F.coalesce(name, absent))
    return tables if config is None else select_schemas(tables, config)


def registered_targets(spark: SparkSession, database: str) -> DataFrame:
    """Names of the tables registered in a database."""
    tables = spark.sql("SHOW TABLES IN `{}`".format(database.replace("`", "``")))
    return tables.where(~F.col("isTemporary")).select(F.col("tableName").alias("target"))


def _described(spark: SparkSession, database: str) -> DataFrame:
    """target, information of the tables registered in a database, from one statement."""
    tables = spark.sql("SHOW TABLE EXTENDED IN `{}` LIKE '*'".format(database.replace("`", "``")))
    return tables.where(~F.col("isTemporary")).select(F.col("tableName").alias("target"), "information")


def _stated(label: str) -> Column:
    """The value of a line of a table's description."""
    return F.regexp_extract("information", f"(?m)^{label}: (.*)$", 1)


def registered_tables(spark: SparkSession, database: str) -> DataFrame:
    """target, catalog_name, schema_name of the tables registered in a database.

    Catalog and schema are those the registration wrote into the table's properties; a table registered
    otherwise has neither. With them a sync deletes by owner instead of by name.
    """
    properties = F.regexp_extract(_stated("Table Properties"), r"^\[(.*)\]$", 1)

    def value(key: str) -> Column:
        found = F.regexp_extract(properties, r"(?:^|, )" + key.replace(".", r"\.") + r"=([^,]*)", 1)
        return F.when(found != "", F.url_decode(found))

    owner = value(CATALOG_PROPERTY).alias("catalog_name"), value(SCHEMA_PROPERTY).alias("schema_name")
    return _described(spark, database).select("target", *owner)


def table_rows(spark: SparkSession, database: str) -> DataFrame:
    """target, n_rows of the Parquet and ORC tables registered in a database.

    The files of all tables of a format are counted in one scan that reads no column, and meet their
    tables by folder. The driver holds the list of locations, one per table.
    """
    tables = _described(spark, database)
    tables = tables.select("target", F.lower(_stated("Provider")).alias("fmt"), _folder(_stated("Location")).alias("folder"))
    locations: dict[str, list[str]] = {}
    for row in tables.toLocalIterator():
        locations.setdefault(row.fmt, []).append(row.folder)
    counts = spark.createDataFrame([], "folder string, n bigint")
    for fmt, folders in locations.items():
        if fmt not in ("parquet", "orc"):
            raise ValueError(f"rows of {fmt} tables are not told by their files")
        files = spark.read.format(fmt).schema(StructType([])).option("recursiveFileLookup", True).load(sorted(set(folders)))
        file = files.select(_folder(F.col("_metadata.file_path")).alias("file")).groupBy("file").agg(F.count("*").alias("n"))
        parts = F.split("file", "/")
        above = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
        counts = counts.unionByName(file.select(F.explode(above).alias("folder"), "n"))
    total = counts.groupBy("folder").agg(F.sum("n").alias("n"))
    return tables.join(total, "folder", "left").select("target", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_rows"))


def _folder(location: Column) -> Column:
    """A location with one spelling of its scheme and without a slash behind."""
    return F.rtrim(F.regexp_replace(location, "^file:/+", "file:/"), F.lit("/"))
