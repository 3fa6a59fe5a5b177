"""Questions about a storage inventory: sizes, levels, existence and empty folders.

An inventory has one row per object or folder with a path relative to the storage root. All folder
totals come from one rollup: rows are first combined per parent folder, and only those per-folder
subtotals are repeated for the folders above. Both steps combine inside map tasks, so a folder that
holds most of the rows, and the root that holds all of them, reach a reducer as a few partial rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewarden.functions.paths import (
    bytes_to_unit,
    leading_parts,
    parent_path,
    path_depth,
    path_parts,
)
from lakewarden.operators.matching import flag_listed, flag_matching


def is_below(path: Column, folder: str) -> Column:
    """True for paths strictly below ``folder``; an empty folder name means the storage root."""
    folder = folder.rstrip("/")
    return path.startswith(f"{folder}/") if folder else F.lit(True)


def below(inventory: DataFrame, folder: str) -> DataFrame:
    return inventory.where(is_below(F.col("path"), folder))


def is_folder() -> Column:
    """True for rows listed as folders; a row that does not say is taken for a file."""
    return F.coalesce(F.col("is_dir"), F.lit(False))


def with_flag(df: DataFrame, name: str, value: bool = False) -> DataFrame:
    """Add a constant boolean column."""
    return df.withColumn(name, F.lit(value))


def set_where(df: DataFrame, name: str, mask: Column) -> DataFrame:
    """Set ``name`` to true where ``mask`` holds and leave the other rows as they are."""
    return df.withColumn(name, F.when(mask, F.lit(True)).otherwise(F.col(name)))


def folder_rollup(inventory: DataFrame) -> DataFrame:
    """One row per folder, listed or implied by a path.

    Columns: ``dir``; ``listed`` (rows naming the folder itself); ``entries``, ``files`` and
    ``bytes`` at any depth below it; ``max_length`` over itself and everything below it.
    """
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    # Each row counts for the folder holding it and, if it is a folder, as a listing of itself.
    # Separate columns, not structs, so that a report reads only what it shows.
    twice = inventory.select(
        "path", "is_dir", "length", F.explode(F.array(F.lit(False), F.lit(True))).alias("itself")
    )
    itself, is_dir, length = F.col("itself"), is_folder(), F.col("length")
    is_file_below = ~itself & ~is_dir
    contributions = twice.where(~itself | is_dir).select(
        F.when(itself, F.col("path")).otherwise(parent_path(F.col("path"))).alias("dir"),
        F.when(itself, one).otherwise(zero).alias("listed"),
        F.when(itself, zero).otherwise(one).alias("entries"),
        F.when(is_file_below, one).otherwise(zero).alias("files"),
        F.when(is_file_below, length).otherwise(zero).alias("bytes"),
        length.alias("max_length"),
    )

    def totals(rows: DataFrame) -> DataFrame:
        return rows.groupBy("dir").agg(
            F.sum("listed").alias("listed"),
            F.sum("entries").alias("entries"),
            F.sum("files").alias("files"),
            F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
            F.max("max_length").alias("max_length"),
        )

    per_parent = totals(contributions.where(F.col("dir").isNotNull()))
    # Subtotals count for the folder itself and for each folder above it. ``listed`` belongs to the
    # folder alone.
    depth = path_depth(F.col("dir"))
    repeated = per_parent.select(
        F.explode(F.sequence(F.lit(1), depth)).alias("level"),
        "*",
        depth.alias("own_level"),
    ).select(
        leading_parts(F.col("dir"), F.col("level")).alias("dir"),
        F.when(F.col("level") == F.col("own_level"), F.col("listed")).otherwise(zero).alias("listed"),
        "entries",
        "files",
        "bytes",
        "max_length",
    )
    return totals(repeated)


def directory_size(inventory: DataFrame, folder: str, unit: str = "GB") -> DataFrame:
    """One row: bytes below ``folder``, exact and in the given unit."""
    files = below(inventory, folder).where(~is_folder())
    return files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).select(
        F.lit(folder.rstrip("/")).alias("dir"),
        "bytes",
        bytes_to_unit(F.col("bytes"), unit).alias("size"),
    )


def directory_sizes(inventory: DataFrame, unit: str = "GB") -> DataFrame:
    """Bytes below every folder, exact and in the given unit."""
    size = bytes_to_unit(F.col("bytes"), unit)
    return folder_rollup(inventory).select("dir", "bytes", size.alias("size"))


def top_level_sizes(inventory: DataFrame) -> DataFrame:
    """Bytes of the files per first path component; a folder without files has none."""
    length = F.when(~is_folder(), F.col("length"))
    first = leading_parts(F.col("path"), F.lit(1)).alias("dir")
    return inventory.groupBy(first).agg(F.coalesce(F.sum(length), F.lit(0)).alias("bytes"))


def level_stats(inventory: DataFrame) -> DataFrame:
    """Per folder: its level, the rows naming it or something below it, and the largest object."""
    return folder_rollup(inventory).select(
        "dir",
        (path_depth(F.col("dir")) - 1).cast("bigint").alias("level"),
        (F.col("listed") + F.col("entries")).alias("rows"),
        "max_length",
    )


def level_values(inventory: DataFrame, level: int | None = None) -> DataFrame:
    """Distinct component names of one level, or of every level."""
    parts = path_parts(F.col("path"))
    if level is not None:
        values = inventory.select(F.get(parts, F.lit(level)).alias("value"))
        return values.where(F.col("value").isNotNull()).distinct()
    return (
        inventory.select(F.posexplode(parts).alias("level", "value"))
        .select(F.col("level").cast("bigint").alias("level"), "value")
        .distinct()
    )


def max_depth(inventory: DataFrame) -> DataFrame:
    """One row: the number of components of the deepest path."""
    deepest = F.max(path_depth(F.col("path"))).cast("bigint")
    return inventory.agg(F.coalesce(deepest, F.lit(0)).alias("max_depth"))


def sort_by_levels(df: DataFrame, depth: int) -> DataFrame:
    """Order by ``L0 .. L<depth-1>``, nulls last.

    Rows of one path follow their other columns, so that a path listed many times can be divided
    between sort ranges and the order does not depend on the run.
    """
    levels = [f"L{i}" for i in range(depth)]
    others = [name for name in df.columns if name not in levels]
    return df.orderBy(*[F.asc_nulls_last(name) for name in levels + others])


def mark_empty_folders(inventory: DataFrame, root: str = "") -> DataFrame:
    """Every listed folder below ``root`` with its depth and an ``empty_folder`` flag.

    A folder is empty when no file lies below it at any depth, so a chain of folders that hold only
    each other is empty as a whole. A zero-byte file keeps its folders.
    """
    entries = below(inventory, root)
    listed = folder_rollup(entries).where(is_below(F.col("dir"), root) & (F.col("listed") > 0))
    flagged = with_flag(
        listed.select(F.col("dir").alias("path"), path_depth(F.col("dir")).cast("bigint").alias("depth"), "files"),
        "empty_folder",
    )
    has_no_file = F.col("files").isNotNull() & (F.col("files") == 0)
    return set_where(flagged, "empty_folder", has_no_file).drop("files")


def delete_order(folders: DataFrame) -> DataFrame:
    """Deepest folders first, so that each is gone before the folder holding it."""
    return folders.orderBy(F.desc("depth"), "path")


def probe_existence(
    requests: DataFrame,
    inventory: DataFrame,
    key: str = "path",
    few_requests: bool = True,
) -> DataFrame:
    """All requested paths with a boolean ``exists``.

    Few requests are matched while the inventory is scanned. Turn ``few_requests`` off when they are
    about as many as the objects: both sides are then shuffled once instead of meeting twice.
    """
    present = inventory.select(F.col("path").alias(key))
    match = flag_listed if few_requests else flag_matching
    return match(requests, present, key, "exists")
