"""Delimited files and whole objects."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyarrow import fs as stores
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakewarden import storage
from lakewarden.sources.tree import list_tree, store_of


def refuse_hidden(path: str | list[str]) -> None:
    """Raise for listed files that Spark would leave out without a word: names with ``_`` or ``.`` in front."""
    for each in [path] if isinstance(path, str) else path:
        if each.rstrip("/").rsplit("/", 1)[-1].startswith(("_", ".")):
            raise ValueError(f"{each} would not be read: its name starts with _ or .")


def refuse_empty(spark: SparkSession, paths: list[str]) -> None:
    """Raise for listed objects of zero bytes, which Spark would leave out without a word."""
    for each in paths:
        if storage.is_empty_file(spark, each):
            raise ValueError(f"{each} would not be read: it is empty")


def scan_csv_inferred(spark: SparkSession, path: str | list[str], schema: StructType | None = None) -> DataFrame:
    """Read CSV whose first line names the columns.

    Types are inferred from all rows, which costs one more pass over the files. Give ``schema`` to
    save that pass.
    """
    if schema is not None:
        return spark.read.schema(schema).csv(path, header=True)
    return spark.read.csv(path, header=True, inferSchema=True)


def scan_csv_declared(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    header: bool = False,
    recursive: bool = False,
) -> DataFrame:
    """Read CSV under a declared schema.

    Without ``header`` a header line is data. Short rows are padded with nulls and long rows cut to
    the schema. ``recursive`` reads every file at any depth below a folder exactly once; folder
    names such as ``year=2024`` are then not turned into columns. Of a folder, names that start with
    ``_`` or ``.`` are not read; listed by path they are an error.
    """
    refuse_hidden(path)
    reader = spark.read.schema(schema).option("recursiveFileLookup", recursive)
    return reader.csv(path, header=header)


def with_lineage(df: DataFrame, column: str = "source_file") -> DataFrame:
    """Add the path of the file each row was read from."""
    return df.select("*", F.col("_metadata.file_path").alias(column))


#: Bytes of an object that a task holds at a time when objects are read in pieces.
PIECE_BYTES = 4 << 20
_URL = re.compile(r"([A-Za-z][A-Za-z0-9+.-]*):(//[^/]*)?(/.*)", re.DOTALL)


def scan_binary(spark: SparkSession, path: str | list[str], glob: str | None = None, piece_bytes: int | None = None) -> DataFrame:
    """Read whole objects as ``path, content``, at any depth below a folder.

    An object is one row, so it must be below 2 GiB, and each task holds one several times over. With
    ``piece_bytes`` objects of any size are read as ``path, start, content``, see ``_in_pieces``.
    Spark leaves out objects of zero bytes and, of a folder, names that start with ``_`` or ``.``;
    listed by path either is an error. ``scan_objects`` leaves nothing out.
    """
    refuse_hidden(path)
    refuse_empty(spark, [path] if isinstance(path, str) else path)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    objects = reader.load(path)
    return objects.select("path", "content") if piece_bytes is None else _in_pieces(objects, None, piece_bytes)


def _tasks(rows: DataFrame) -> int:
    return max(1, min(rows.count(), 8 * rows.sparkSession.sparkContext.defaultParallelism))


def _inner_bytes(data: bytes) -> int:
    """How many of the first three bytes continue a UTF-8 character that began before them."""
    return next((n for n, byte in enumerate(data[:3]) if byte & 0xC0 != 0x80), len(data[:3]))


def _opened(url: str) -> tuple[stores.FileSystem, str]:
    """The store of an object and the path in it, for a path as Spark's readers give it: nothing in it is escaped."""
    scheme, host, place = _URL.fullmatch(url).groups()
    store, base = stores.FileSystem.from_uri(f"{scheme}:{host or '//'}/")
    return store, base.rstrip("/") + place


def _pieces(root: str | None, piece_bytes: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, length, start in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if root is None:
                store, place = _opened(path)
            else:
                store, base = store_of(root)
                place = f"{base}/{path}"
            with store.open_input_file(place) as file:
                data = file.read_at(min(piece_bytes + 3, length - start), start)
            if len(data) < min(piece_bytes + 3, length - start):
                raise OSError(f"{path} is shorter than it was when listed")
            skipped = _inner_bytes(data) if start else 0
            content = data[skipped : piece_bytes + _inner_bytes(data[piece_bytes:])]
            columns = [pa.array([path]), pa.array([start + skipped], pa.int64()), pa.array([content], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["path", "start", "content"])


def _in_pieces(objects: DataFrame, root: str | None, piece_bytes: int) -> DataFrame:
    """Objects (path, length) as ``path, start, content``: pieces that join to the whole, in tasks.

    ``start`` is the place of the piece's first byte. A piece has ``piece_bytes``, up to three more or
    fewer, so that it ends between two characters where the object is text in UTF-8. Pieces of one
    object go to several tasks, and a task holds one at a time. An object of zero bytes is one piece.
    """
    if piece_bytes < 1:
        raise ValueError(f"pieces of {piece_bytes} bytes")
    starts = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(piece_bytes).cast("bigint"))
    pieces = objects.select("path", "length", F.explode(starts).alias("start"))
    read = partial(_pieces, root, piece_bytes)
    return pieces.repartition(_tasks(pieces)).mapInArrow(read, "path string, start bigint, content binary")


def _contents(root: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    store, base = store_of(root)
    for batch in batches:
        for path in batch.column("path").to_pylist():
            with store.open_input_stream(f"{base}/{path}") as stream:
                content = stream.read()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([content], pa.binary())], ["path", "content"])


def scan_objects(spark: SparkSession, root: str, where: Column | None = None, piece_bytes: int | None = None) -> DataFrame:
    """Whole objects below ``root`` as ``path, content``: empty ones and those with hidden names too.

    Paths are relative to the root. ``where`` chooses among the rows of ``list_tree`` before anything is
    read. An object is one row, so it must be below 2 GiB. With ``piece_bytes`` objects of any size are
    read as ``path, start, content``, see ``_in_pieces``.
    """
    files = list_tree(spark, root).where("NOT is_dir")
    if where is not None:
        files = files.where(where)
    if piece_bytes is not None:
        return _in_pieces(files, root, piece_bytes)
    return files.select("path").repartition(_tasks(files)).mapInArrow(partial(_contents, root), "path string, content binary")
