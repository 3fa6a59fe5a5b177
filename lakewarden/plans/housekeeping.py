"""Reports over a storage inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lakewarden.operators import inventory as ops


def find_empty_folders(inventory: DataFrame, root: str = "") -> DataFrame:
    """Listed folders below ``root`` that hold no file at any depth, in an order safe to delete in."""
    return ops.delete_order(ops.mark_empty_folders(inventory, root).where("empty_folder"))


def directory_sizes(inventory: DataFrame, unit: str = "GB") -> DataFrame:
    """Bytes below every folder."""
    return ops.directory_sizes(inventory, unit)
