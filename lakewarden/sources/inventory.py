"""Storage listings as inventory tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewarden.functions.paths import relative_path, strip_trailing_slash
from lakewarden.operators.inventory import is_below
from lakewarden.schemas import INVENTORY_SCHEMA

# Delimited and JSON exports are read strictly: a listing row that does not fit is an error, since a
# row silently turned into nulls would make its folder look empty.
_STRICT_FORMATS = {"csv", "json"}
_REQUIRED = ("path", "is_dir")


def inventory(spark: SparkSession, export: str, fmt: str = "parquet") -> DataFrame:
    """Read an exported listing of objects and folders.

    The export must hold folders as rows with ``is_dir``, since empty folders appear nowhere else. A
    Parquet export without ``path`` or ``is_dir``, and a text row without a value for either, is an
    error. Paths are relative to the root: leading, trailing and repeated slashes go.
    """
    reader = spark.read.schema(INVENTORY_SCHEMA).format(fmt)
    if fmt in _STRICT_FORMATS:
        rows = reader.option("mode", "FAILFAST").load(export)
        for name in _REQUIRED:
            absent = F.raise_error(F.lit(f"a row of the inventory has no {name}")).cast(rows.schema[name].dataType)
            rows = rows.withColumn(name, F.coalesce(name, absent))
    else:
        found = spark.read.format(fmt).load(export).columns
        if lacking := [name for name in _REQUIRED if name not in found]:
            raise ValueError(f"the inventory has no column {', '.join(lacking)}")
        rows = reader.load(export)
    path = F.ltrim(F.regexp_replace("path", "/{2,}", "/"), F.lit("/"))
    return rows.withColumn("path", strip_trailing_slash(path))


def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Objects below ``root`` as an inventory of files, without reading their content.

    Folders, zero-byte objects and objects whose names start with ``_`` or ``.`` are not listed, so
    this serves sizes but not the search for empty folders. Spark keeps the file list of a scan on
    the driver: for a whole lake of small objects read an export with ``inventory`` instead.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(root).select(
        relative_path(F.col("path"), root).alias("path"),
        F.lit(False).alias("is_dir"),
        "length",
        F.col("modificationTime").alias("modified"),
    )


def names_in_folder(listing: DataFrame, folder: str) -> DataFrame:
    """Names of the entries directly in ``folder``, as registered targets."""
    folder = folder.rstrip("/")
    start = F.lit(len(folder) + 2 if folder else 1)
    name = F.substr(F.col("path"), start)
    names = listing.where(is_below(F.col("path"), folder)).select(name.alias("target"))
    return names.where(~F.col("target").contains("/"))
