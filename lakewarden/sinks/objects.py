"""Whole objects: written from rows and copied byte for byte, in tasks.

Objects first go to a staging folder beside the target: each under a name of its own attempt, renamed
when it is complete and its bytes, read back, have the checksum of what was sent. So a repeated or
doubled task does no harm. When all tasks are done, the driver publishes the staging folder with one
rename; if any of them fails, it deletes it and the target is as it was.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
from pyarrow import fs as stores
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewarden import storage
from lakewarden.session import new_folder
from lakewarden.sources.tree import list_tree, store_of

CHUNK = 8 << 20
WRITTEN = "path string, is_dir boolean, length bigint, crc32 bigint"


@dataclass(frozen=True)
class ObjectsResult:
    """What was written: path below the target, is_dir, length and crc32 of each object."""

    written: DataFrame
    # For a move: full paths of the source objects that may be deleted now.
    removable: DataFrame | None = None


def _chunks(store: stores.FileSystem, path: str) -> Iterator[bytes]:
    with store.open_input_stream(path) as stream:
        while chunk := stream.read(CHUNK):
            yield chunk


def _put(store: stores.FileSystem, base: str, path: str, chunks: Iterator[bytes]) -> tuple[int, int]:
    """Write one object below ``base``; its length and checksum, after it was read back."""
    attempt = f"{base}.attempts/{uuid.uuid4().hex}"
    store.create_dir(f"{base}.attempts", recursive=True)
    length = crc = 0
    with store.open_output_stream(attempt) as out:
        for chunk in chunks:
            out.write(chunk)
            length, crc = length + len(chunk), zlib.crc32(chunk, crc)
    found = 0
    for chunk in _chunks(store, attempt):
        found = zlib.crc32(chunk, found)
    if found != crc:
        raise OSError(f"{path} does not read back as it was written")
    place = f"{base}/{path}"
    store.create_dir(place.rsplit("/", 1)[0], recursive=True)
    store.move(attempt, place)
    return length, crc


def _rows(out: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.bool_(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["path", "is_dir", "length", "crc32"])


def _refused(path: str | None) -> bool:
    return not path or path.startswith("/") or ".." in path.split("/")


def _put_rows(staging: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    store, base = store_of(staging)
    for batch in batches:
        out = []
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
            if _refused(path):
                raise ValueError(f"no path below the target: {path!r}")
            if not content.is_valid:
                store.create_dir(f"{base}/{path}", recursive=True)
                out.append((path, True, 0, 0))
            else:
                out.append((path, False, *_put(store, base, path, iter([content.as_buffer()]))))
        if out:
            yield _rows(out)


def _copied(source: str, staging: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    (origin, root), (store, base) = store_of(source), store_of(staging)
    for batch in batches:
        for path, is_dir in zip(batch.column("path").to_pylist(), batch.column("is_dir").to_pylist(), strict=True):
            if is_dir:
                store.create_dir(f"{base}/{path}", recursive=True)
                yield _rows([(path, True, 0, 0)])
            else:
                yield _rows([(path, False, *_put(store, base, path, _chunks(origin, f"{root}/{path}")))])


@contextmanager
def _published(spark: SparkSession, target: str, remove_target: bool) -> Iterator[str]:
    """A staging folder that becomes ``target`` if the block succeeds and goes if it does not."""
    target = target.rstrip("/")
    if storage.exists(spark, target) and not remove_target:
        raise ValueError(f"{target} exists")
    staging = f"{target}.staged-{uuid.uuid4().hex}"
    try:
        storage.make_folder(spark, staging)
        yield staging
        if storage.exists(spark, target):
            old = f"{staging}.old"
            storage.rename(spark, target, old)
            storage.rename(spark, staging, target)
            storage.delete(spark, old)
        else:
            storage.rename(spark, staging, target)
    finally:
        for left in (staging, f"{staging}.attempts"):
            storage.delete(spark, left)


def put_objects(rows: DataFrame, target: str, remove_target: bool = False) -> ObjectsResult:
    """Write each row (path, content) as an object below ``target``, which becomes the folder of just these.

    A row without content makes a folder. Paths are relative; a path that leaves the target is an error,
    and so is a target that exists unless ``remove_target`` is set. Of rows that share a path one is
    kept, any of them.
    """
    spark, folder = rows.sparkSession, new_folder(rows.sparkSession, "objects")
    with _published(spark, target, remove_target) as staging:
        rows.select("path", F.col("content").cast("binary")).mapInArrow(partial(_put_rows, staging), WRITTEN).write.parquet(folder)
    return ObjectsResult(spark.read.schema(WRITTEN).parquet(folder))


def copy_objects(spark: SparkSession, source: str, target: str, remove_target: bool = False, move: bool = False) -> ObjectsResult:
    """Copy every object and folder below ``source``, of any format and name, byte for byte.

    Empty objects and folders are copied too. An existing target is an error unless ``remove_target``
    is set; then it is replaced once the copy is complete. With ``move`` the result names the objects
    that were copied, for ``delete_objects``; a copy deletes nothing.
    """
    listing = list_tree(spark, source)
    folder = new_folder(spark, "copied-objects")
    tasks = max(1, min(listing.count(), 8 * spark.sparkContext.defaultParallelism))
    with _published(spark, target, remove_target) as staging:
        listing.repartition(tasks).mapInArrow(partial(_copied, source, staging), WRITTEN).write.parquet(folder)
    written = spark.read.schema(WRITTEN).parquet(folder)
    removable = written.where(~F.col("is_dir")).select(F.concat(F.lit(source.rstrip("/") + "/"), "path").alias("path"))
    return ObjectsResult(written, removable if move else None)


def _deleted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        gone = []
        for path in batch.column("path").to_pylist():
            store, place = store_of(path)
            there = store.get_file_info(place).type == stores.FileType.File
            if there:
                store.delete_file(place)
            gone.append(there)
        yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(gone)], ["path", "deleted"])


def delete_objects(paths: DataFrame) -> DataFrame:
    """Delete the objects of column ``path``, in tasks: path, deleted (false: it was not there). Folders stay."""
    folder = new_folder(paths.sparkSession, "deleted")
    paths.select("path").distinct().mapInArrow(_deleted, "path string, deleted boolean").write.parquet(folder)
    return paths.sparkSession.read.parquet(folder)
