"""Applying a sync plan: external tables are created or dropped, data is neither copied nor removed.

DDL runs on the driver, one statement per created or dropped table, several in flight. Only those plan
rows reach it, one partition at a time, and outcomes go to the shared folder chunk by chunk.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import partial
from itertools import islice
from urllib.parse import quote

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from lakewarden import storage
from lakewarden.operators.matching import drop_matching
from lakewarden.schemas import CATALOG_PROPERTY, OUTCOME_SCHEMA, SCHEMA_PROPERTY
from lakewarden.session import new_folder


def _quoted(*parts: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


def _text(value: str) -> str:
    """A string as an SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _create(spark: SparkSession, database: str, row: Row) -> tuple[str, str | None]:
    name = _quoted(database, row.target)
    # The owner is what a later run may delete by; names alone do not tell schemas apart.
    owner = {CATALOG_PROPERTY: row.catalog_name, SCHEMA_PROPERTY: row.schema_name}
    properties = ", ".join(f"{_text(key)} = {_text(quote(value, safe=''))}" for key, value in owner.items() if value is not None)
    statement = f"CREATE TABLE {name} USING {_quoted(row.data_source_format.lower())} LOCATION {_text(row.storage_location)}"
    try:
        spark.sql(f"{statement} TBLPROPERTIES ({properties})" if properties else statement)
    except AnalysisException as error:
        if error.getCondition() != "TABLE_OR_VIEW_ALREADY_EXISTS":
            raise
        return "skipped", "a table with this name exists"
    return "created", None


def _drop(spark: SparkSession, database: str, row: Row) -> tuple[str, str | None]:
    name = _quoted(database, row.target)
    try:
        table = spark.catalog.getTable(name)
    except AnalysisException as error:
        if error.getCondition() != "TABLE_OR_VIEW_NOT_FOUND":
            raise
        return "already_absent", None
    # Dropping a managed table would delete its data.
    if table.tableType != "EXTERNAL":
        return "failed", "not an external table"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    return "deleted", None


def _attempt(action, spark: SparkSession, database: str, row: Row) -> tuple:
    try:
        outcome, message = action(spark, database, row)
    except PySparkException as error:
        outcome, message = "failed", str(error).split("\n", 1)[0]
    return row.target, row.operation, outcome, message


def _apply(action, planned: DataFrame, database: str, in_flight: int, chunk: int, journal: str | None) -> DataFrame:
    """One statement per row, ``in_flight`` at a time; outcomes are written after every ``chunk`` rows.

    The driver holds one chunk, however long the plan is. Statements of different names do not depend
    on one another, so their number in flight changes no outcome. Rows whose outcome stands in the
    ``journal`` already are not attempted again.
    """
    spark = planned.sparkSession
    folder = journal or new_folder(spark, "outcomes")
    if storage.exists(spark, folder):
        planned = drop_matching(planned, spark.read.schema(OUTCOME_SCHEMA).parquet(folder), "target")
    else:
        spark.createDataFrame([], OUTCOME_SCHEMA).write.parquet(folder)
    rows = planned.toLocalIterator()
    with ThreadPoolExecutor(in_flight) as pool:
        while some := list(islice(rows, chunk)):
            outcomes = list(pool.map(partial(_attempt, action, spark, database), some))
            spark.createDataFrame(outcomes, OUTCOME_SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    return spark.read.schema(OUTCOME_SCHEMA).parquet(folder)


def unregister_tables(
    spark: SparkSession, planned: DataFrame, database: str, in_flight: int = 4, chunk: int = 10_000, journal: str | None = None
) -> DataFrame:
    """Drop the registration of every ``delete`` row.

    ``journal`` names a folder of outcomes: a run that is given the folder of one that broke off goes on
    after the last chunk written there.
    """
    wanted = planned.where("operation = 'delete'").select("target", "operation")
    return _apply(_drop, wanted, database, in_flight, chunk, journal)


def register_tables(
    spark: SparkSession, planned: DataFrame, database: str, in_flight: int = 4, chunk: int = 10_000, journal: str | None = None
) -> DataFrame:
    """Register the location of every ``create`` row; other source rows are passed on as skipped.

    The table's properties name the catalog and schema it comes from, where the plan does. ``journal``
    as for ``unregister_tables``.
    """
    owner = [F.col(c) if c in planned.columns else F.lit(None).cast("string").alias(c) for c in ("catalog_name", "schema_name")]
    wanted = planned.where("operation = 'create'").select(
        "target", "operation", "storage_location", "data_source_format", *owner
    )
    passed_over = planned.where("operation IN ('skip', 'conflict')").selectExpr(
        "target", "operation", "'skipped' AS outcome", "reason AS message"
    )
    return _apply(_create, wanted, database, in_flight, chunk, journal).unionByName(passed_over)
