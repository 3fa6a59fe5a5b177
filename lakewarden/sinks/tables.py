"""Table writes.

``fmt`` names a Spark data source: ``delta`` where that source is installed, else ``parquet``. Only
a format with a commit log replaces a table atomically.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from lakewarden import storage

# Casts that lose nothing, from -> to.
_WIDER = {
    "tinyint": {"smallint", "int", "bigint", "double"},
    "smallint": {"int", "bigint", "double"},
    "int": {"bigint", "double"},
    "float": {"double"},
}
# Formats whose files may differ in columns and can be read as their union.
_MERGED = ("parquet", "orc")
_TEXT = ("csv", "json", "text", "xml")
_MISSING = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "DELTA_PATH_DOES_NOT_EXIST", "DELTA_TABLE_NOT_FOUND"}


def _column(name: str) -> Column:
    """The column of this very name, dots and other signs included."""
    return F.col("`" + name.replace("`", "``") + "`")


def _save(df: DataFrame, path: str, fmt: str, mode: str, partition_by: tuple[str, ...]) -> None:
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The table at ``path`` with the columns of all its files, or nothing if there is none."""
    reader = spark.read.format(fmt)
    if fmt in _MERGED:
        reader = reader.option("mergeSchema", True)
    try:
        return reader.load(path)
    except AnalysisException as error:
        # A folder without data files, as a failed first write leaves it, is no table either.
        if (error.getCondition() or "").split(".")[0] in _MISSING or "Unable to infer schema" in str(error):
            return None
        raise


def require_columns(new: StructType, table: StructType, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Raise unless rows of ``new`` fit the table: the same columns, of the same or a narrower type.

    Types of partition columns are not compared, as readers infer them from folder names.
    """
    have, want = ({f.name: f.dataType.simpleString() for f in s} for s in (new, table))
    problems = [f"{name} is not in the table" for name in have if name not in want]
    problems += [f"{name} is missing" for name in want if name not in have]
    for name in have.keys() & want.keys() - set(partition_by):
        if have[name] != want[name] and want[name] not in _WIDER.get(have[name], ()):
            problems.append(f"{name} is {have[name]}, in the table {want[name]}")
    if problems:
        raise ValueError(f"rows do not fit {path}: " + "; ".join(sorted(problems)))


def fitted(df: DataFrame, table: DataFrame | None, path: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` as rows of ``table``: its columns in its order, narrower types cast. Anything else is an error."""
    if table is None or not table.columns:
        return df
    require_columns(df.schema, table.schema, path, partition_by)
    return df.select(*[_column(c) if c in partition_by else _column(c).cast(table.schema[c].dataType).alias(c) for c in table.columns])


def append_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> None:
    """Add rows to a table, creating it if needed.

    Rows for an existing table must have its columns; narrower types are cast, and the columns are
    written in the table's order. Anything else is an error before a row is written.
    """
    table = read_table(df.sparkSession, path, fmt)
    _save(fitted(df, table, path, partition_by), path, fmt, "append", partition_by)


def append_once(df: DataFrame, path: str, fmt: str, writer: str, batch: int) -> None:
    """Add the rows of a writer's numbered batch to a table, however often the same batch is offered.

    A format with a commit log keeps the number itself. For others the batch is written to a hidden
    folder of the table, its files are renamed into the table under names that tell writer and batch,
    and a hidden file marks the batch as done. A run that broke off in between is cleared away and
    repeated; files of other writers are not touched.
    """
    spark = df.sparkSession
    if fmt not in _MERGED:
        df.write.format(fmt).mode("append").option("txnAppId", writer).option("txnVersion", batch).save(path)
        return
    path = path.rstrip("/")
    ledger, own = f"{path}/_batches/{writer}", f"part-{writer}-{batch:09d}-"
    if storage.exists(spark, f"{ledger}/{batch}"):
        return
    staged = f"{ledger}/staged-{batch}"
    df.write.format(fmt).mode("overwrite").save(staged)
    for name in storage.names(spark, path, f"{own}*"):
        storage.delete(spark, f"{path}/{name}")
    for number, name in enumerate(sorted(storage.names(spark, staged, "part-*"))):
        ending = name.partition(".")[2]
        storage.rename(spark, f"{staged}/{name}", f"{path}/{own}{number:05d}.{ending}")
    storage.create_empty(spark, f"{ledger}/{batch}")
    storage.delete(spark, staged)


def overwrite_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> None:
    """Replace a table's rows.

    Without a commit log readers may find no rows meanwhile; ``replace_registered`` has no such gap.
    """
    _save(df, path, fmt, "overwrite", partition_by)


def replace_registered(df: DataFrame, name: str, folder: str, partition_by: tuple[str, ...] = ()) -> str:
    """Replace the rows of the registered table ``name`` without a moment when it has none.

    The rows are written to ``folder``, which must not exist, read back and counted, and then the
    table is pointed there. Readers see the old rows or the new; a failure before that leaves the table
    as it was. Returns the old location, which nobody deletes here: readers may still be at it.
    """
    spark = df.sparkSession
    details = {row.col_name: row.data_type for row in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    fmt, old = details["Provider"].lower(), details["Location"]
    if storage.exists(spark, folder):
        raise ValueError(f"{folder} exists; a replacement needs a folder of its own")
    counted = Observation("replacing rows")
    rows = fitted(df, spark.table(name), name, partition_by).observe(counted, F.count(F.lit(1)).alias("n"))
    _save(rows, folder, fmt, "errorifexists", partition_by)
    found = spark.read.format(fmt).schema(rows.schema).load(folder).count()
    if found != counted.get["n"]:
        raise RuntimeError(f"{folder} holds {found} rows, not the {counted.get['n']} written")
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
    if partition_by:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    spark.catalog.refreshTable(name)
    return old


@dataclass(frozen=True)
class CopyResult:
    rows: int
    # For a move: the source files that may be deleted now. Nothing is deleted here.
    removable: DataFrame | None


def copy_dataset(
    spark: SparkSession,
    source: str,
    target: str,
    fmt: str = "parquet",
    remove_target: bool = False,
    move: bool = False,
    partition_by: tuple[str, ...] = (),
) -> CopyResult:
    """Copy a dataset and check that the target holds the rows and columns that were read.

    Files that differ in columns are read as their union. Values of partition folders are text and
    stay as they are; without ``partition_by`` the layout of the source is kept. Text formats have no
    fixed rows and are refused. The rows read are counted and hashed while they are copied. An existing
    target is an error unless ``remove_target`` is set.

    ``removable`` of a move names the files that were copied, and no others.
    """
    if fmt in _TEXT:
        raise ValueError(f"{fmt} files are not tables; copy them as objects")
    rows = _as_written(spark, source, fmt)
    files = rows.select(F.col("_metadata.file_path").alias("path")).distinct() if move else None
    layout = partition_by or _partition_columns(rows, source)
    counted = Observation("copied rows")
    summary = digest(rows.schema)
    _save(rows.observe(counted, *summary), target, fmt, "overwrite" if remove_target else "errorifexists", layout)
    copied = counted.get
    target_rows = _as_written(spark, target, fmt)
    if set(target_rows.columns) != set(rows.columns):
        raise RuntimeError(f"{target} has columns {target_rows.columns}, {source} {rows.columns}")
    typed = target_rows.select(*[_column(f.name).cast(f.dataType).alias(f.name) for f in rows.schema])
    found = typed.agg(*summary).first()
    if copied != found.asDict():
        raise RuntimeError(f"{target} holds {found['n']} rows that differ from the {copied['n']} copied")
    return CopyResult(copied["n"], files)


def _as_written(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """A dataset with the columns of all its files and the text of its partition folders."""
    name = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        reader = spark.read.format(fmt)
        return (reader.option("mergeSchema", True) if fmt in _MERGED else reader).load(path)
    finally:
        spark.conf.set(name, before)


def _partition_columns(rows: DataFrame, source: str) -> tuple[str, ...]:
    """Names of the partition folders above the first file."""
    first = rows.select("_metadata.file_path").first()
    below = first[0].rsplit(source.rstrip("/").rsplit("/", 1)[-1] + "/", 1)[-1] if first else ""
    return tuple(name for name in re.findall(r"([^/=]+)=[^/]*/", below) if name in rows.columns)


def _canonical(value: Column, kind: DataType) -> Column:
    """The value with the entries of maps, at any depth, in the order of their keys."""
    if isinstance(kind, MapType):
        entries = F.transform(F.map_entries(value), lambda e: F.struct(e["key"].alias("k"), _canonical(e["value"], kind.valueType).alias("v")))
        return F.array_sort(entries, lambda a, b: F.when(a["k"] < b["k"], -1).when(a["k"] > b["k"], 1).otherwise(0))
    if isinstance(kind, ArrayType) and _has_map(kind):
        return F.transform(value, lambda item: _canonical(item, kind.elementType))
    if isinstance(kind, StructType) and _has_map(kind):
        fields = F.struct(*[_canonical(value.getField(f.name), f.dataType).alias(f.name) for f in kind])
        return F.when(value.isNotNull(), fields)
    return value


def _has_map(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return any(_has_map(f.dataType) for f in kind)
    return isinstance(kind, MapType) or (isinstance(kind, ArrayType) and _has_map(kind.elementType))


def digest(schema: StructType) -> tuple[Column, ...]:
    """Aggregates that tell two bags of rows apart, in whatever order their rows and maps' entries come.

    The exclusive or of row hashes alone would not see two equal rows vanish, so their sums are taken
    too: in halves, whose sums stay exact for 2**39 rows. Nulls count by place: a row hash leaves them
    out, so the row's null columns go into it as well.
    """
    fields = sorted(schema, key=lambda f: f.name)
    columns = [(_column(f.name), f.dataType) for f in fields]
    nulls = F.concat_ws("", F.lit(""), *[F.when(c.isNull(), "1").otherwise("0") for c, _ in columns])
    row = F.xxhash64(nulls, *[_canonical(c, kind) for c, kind in columns])
    low, high = row.bitwiseAND(F.lit(0xFFFFFF)), F.shiftright(row, 40).bitwiseAND(F.lit(0xFFFFFF))
    return (
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(row).alias("hash"),
        F.sum(low).alias("low"),
        F.sum(high).alias("high"),
    )
