"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


# A shuffle partition of this size sorts within the memory of one task.
SHUFFLE_PARTITION_BYTES = 128 * 1024**2


def shuffle_partitions(shuffle_bytes: int) -> int:
    """Partitions for a shuffle of the given size."""
    return max(1, -(-shuffle_bytes // SHUFFLE_PARTITION_BYTES))


def build_session(
    app_name: str = "lakewarden",
    master: str | None = None,
    shuffle_bytes: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with UTC timestamps and adaptive execution.

    ``shuffle_bytes`` is the size of the largest shuffle expected. Adaptive execution starts from
    that many partitions, coalesces small ones and splits skewed ones. Without it the cluster's own
    settings decide.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master is not None:
        builder = builder.master(master)
    if shuffle_bytes is not None:
        partitions = shuffle_partitions(shuffle_bytes)
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", partitions)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder, because driver and executors
    are then one process. A cluster session without it is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="lakewarden-"))
    return context.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing path below the shared folder."""
    return f"{shared_folder(spark)}/lakewarden/{label}-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Within the block, these settings of the session hold; its own return after it."""
    before = {name: spark.conf.get(name) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def without_sorts(spark: SparkSession) -> dict[str, str]:
    """Settings under which large joins and writes into folders by column seldom sort, as sorts spill.

    Adaptive execution joins by hash where it finds each partition of a side small, and a task that
    writes keeps up to 64 folders open. Where that does not hold, Spark sorts as it does without them.
    """
    return {
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes"),
        "spark.sql.maxConcurrentOutputFileWriters": "64",
    }
