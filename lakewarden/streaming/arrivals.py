"""Ingestion of arriving CSV files where a rerun adds only what is new."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakewarden import storage
from lakewarden.sinks.tables import append_once, fitted, read_table

# The checkpoint is the ledger of files: none is too old to be new.
ANY_AGE = "36500d"


def ingest_new_files(
    spark: SparkSession,
    source: str,
    target: str,
    schema: StructType,
    checkpoint: str,
    fmt: str = "parquet",
    header: bool = False,
    lineage: bool = False,
    files_per_batch: int | None = None,
) -> None:
    """Append every file below ``source`` that ``checkpoint`` has not seen, then stop.

    The checkpoint is the ledger of files; it must lie in storage all executors share. After a
    failure the same call goes on where the last committed batch ended. ``files_per_batch`` bounds
    one commit when a first run meets a large backlog; the folder is listed once per run. Files of any
    age are taken; Spark leaves out names that start with ``_`` or ``.``.

    The target may have rows and other writers: they stay, and a batch that is repeated after a failure
    is written once (``append_once``). An existing target must have the columns of ``schema``, of the
    same or a wider type.
    """
    if storage.exists(spark, f"{target.rstrip('/')}/_spark_metadata"):
        raise ValueError(f"{target} is kept by a stream's own log, which would hide rows added otherwise")
    reader = spark.readStream.schema(schema).option("header", header).option("recursiveFileLookup", True)
    reader = reader.option("maxFileAge", ANY_AGE)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.csv(source)
    if lineage:
        rows = rows.select("*", F.col("_metadata.file_path").alias("source_file"))
    rows = fitted(rows, read_table(spark, target, fmt), target)
    writer = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]

    def add(batch: DataFrame, number: int) -> None:
        append_once(batch, target, fmt, writer, number)

    query = (
        rows.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
