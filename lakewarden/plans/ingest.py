"""Loading delimited files into tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lakewarden.schemas import ORDER_SCHEMA
from lakewarden.sinks.tables import append_table, overwrite_table, read_table
from lakewarden.sources.files import scan_csv_declared, scan_csv_inferred, with_lineage

PREVIEW_ROWS = 5


def ingest_files(
    spark: SparkSession,
    source: str | list[str],
    target: str,
    schema: StructType,
    fmt: str = "parquet",
    header: bool = False,
    lineage: bool = False,
) -> DataFrame:
    """Append every file below a folder, or every listed file, in one scan and one commit.

    A rerun appends the files again; use ``streaming.arrivals.ingest_new_files`` where that matters.
    """
    rows = scan_csv_declared(spark, source, schema, header=header, recursive=True)
    if lineage:
        rows = with_lineage(rows)
    append_table(rows, target, fmt)
    return spark.read.format(fmt).load(target)


def ingest_orders(
    spark: SparkSession,
    source: str,
    target: str,
    schema: StructType = ORDER_SCHEMA,
    fmt: str = "parquet",
) -> DataFrame:
    """Append headerless order files as raw text columns and return the table."""
    return ingest_files(spark, source, target, schema, fmt)


def preview(df: DataFrame, rows: int = PREVIEW_ROWS) -> DataFrame:
    return df.limit(rows)


def load_csv(
    spark: SparkSession,
    source: str,
    target: str,
    mode: str = "append",
    fmt: str = "parquet",
    schema: StructType | None = None,
) -> DataFrame:
    """Load one headed CSV into a table and return the preview of the rows read.

    Appended rows are read under the table's own columns, if there is one: a file that does not fit
    them is an error.
    """
    writers = {"append": append_table, "overwrite": overwrite_table}
    if mode not in writers:
        raise ValueError(f"mode {mode!r} is not one of {sorted(writers)}")
    table = read_table(spark, target, fmt) if mode == "append" and schema is None else None
    if table is not None:
        strict = spark.read.schema(table.schema).option("mode", "FAILFAST").option("enforceSchema", False)
        rows = strict.csv(source, header=True)
    else:
        rows = scan_csv_inferred(spark, source, schema)
    writers[mode](rows, target, fmt)
    return preview(rows)
