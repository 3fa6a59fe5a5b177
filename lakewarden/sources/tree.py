"""Live listings: every folder and object below a root, whatever its size or name.

Spark's file sources leave out empty objects, empty folders and names that start with ``_`` or ``.``.
Here folders are listed by tasks, one level of the tree after the other: the folders a level finds are
dealt to the tasks of the next. The driver learns how many there are, never their names.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from datetime import UTC, datetime
from functools import partial

import pyarrow as pa
from pyarrow import fs as stores
from pyspark.sql import DataFrame, SparkSession

from lakewarden.schemas import INVENTORY_SCHEMA
from lakewarden.session import new_folder

#: Entries of one batch of results.
ENTRIES = 10_000
_COLUMNS = pa.schema([("path", pa.string()), ("is_dir", pa.bool_()), ("length", pa.int64()), ("modified", pa.timestamp("us", tz="UTC"))])


def store_of(root: str) -> tuple[stores.FileSystem, str]:
    """The store of a path or URL and the path in it."""
    return stores.FileSystem.from_uri(root.rstrip("/") or "/")


def entries(store: stores.FileSystem, folder: str) -> Iterator[tuple]:
    """(name, is_dir, length, modified) of what lies directly in a folder; local ones are read as a stream."""
    if isinstance(store, stores.LocalFileSystem):
        with os.scandir(folder or "/") as found:
            for entry in found:
                about = entry.stat(follow_symlinks=False)
                is_dir = entry.is_dir(follow_symlinks=False)
                yield entry.name, is_dir, 0 if is_dir else about.st_size, datetime.fromtimestamp(about.st_mtime, UTC)
        return
    for info in store.get_file_info(stores.FileSelector(folder, recursive=False)):
        is_dir = info.type == stores.FileType.Directory
        yield info.base_name, is_dir, 0 if is_dir else info.size, info.mtime


def _listed(root: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    store, base = store_of(root)
    out: list[tuple] = []
    for batch in batches:
        for folder in batch.column("path").to_pylist():
            start = f"{folder}/" if folder else ""
            for name, *rest in entries(store, f"{base}/{folder}".rstrip("/")):
                out.append((start + name, *rest))
                if len(out) >= ENTRIES:
                    yield _batch(out)
                    out = []
    if out:
        yield _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _COLUMNS, strict=True)], schema=_COLUMNS)


def list_tree(spark: SparkSession, root: str) -> DataFrame:
    """Everything below ``root`` as an inventory: path relative to it, is_dir, length (0 of folders), modified.

    Folders appear as rows, empty ones too; objects of zero bytes and hidden names as any other. The
    root itself is no row. A root that is missing or no folder is an error. Works on stores that
    pyarrow reaches from the executors: shared and local folders, HDFS, S3, GCS and Azure.

    A folder is listed by one task; so a folder's listing is the unit of work, a tree's is not.
    """
    folder = new_folder(spark, "tree")
    level, found, depth = spark.createDataFrame([("",)], "path string"), 1, 0
    while found:
        # One task per folder while they are few, and some rounds of tasks when they are many.
        tasks = min(found, 8 * spark.sparkContext.defaultParallelism)
        rows = level.repartition(tasks).mapInArrow(partial(_listed, root), INVENTORY_SCHEMA)
        rows.write.parquet(f"{folder}/level={depth}")
        level = spark.read.schema(INVENTORY_SCHEMA).parquet(f"{folder}/level={depth}").where("is_dir").select("path")
        found, depth = level.count(), depth + 1
    return spark.read.schema(INVENTORY_SCHEMA).parquet(f"{folder}/level=*")
