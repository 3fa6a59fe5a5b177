"""Single calls to the store of a path, made by the driver: existence, rename, delete, one folder's names.

They go through Spark's own file systems, so any store that Spark reads will do. None of them walks a
tree; that is what ``sources.tree.list_tree`` does, in tasks.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _store(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    store, location = _store(spark, path)
    return store.exists(location)


def is_empty_file(spark: SparkSession, path: str) -> bool:
    store, location = _store(spark, path)
    about = store.getFileStatus(location) if store.exists(location) else None
    return about is not None and about.isFile() and about.getLen() == 0


def names(spark: SparkSession, folder: str, pattern: str = "*") -> list[str]:
    """Names directly in a folder, hidden ones included."""
    store, location = _store(spark, f"{folder.rstrip('/')}/{pattern}")
    return [found.getPath().getName() for found in store.globStatus(location) or []]


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Rename; the target must not exist. Raises where the store refuses."""
    store, location = _store(spark, source)
    if not store.rename(location, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"{source} could not be renamed to {target}")


def delete(spark: SparkSession, path: str) -> None:
    store, location = _store(spark, path)
    store.delete(location, True)


def make_folder(spark: SparkSession, path: str) -> None:
    store, location = _store(spark, path)
    store.mkdirs(location)


def create_empty(spark: SparkSession, path: str) -> None:
    store, location = _store(spark, path)
    store.create(location, True).close()
