"""Keeping a target database's external tables in step with a source catalog."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lakewarden import storage
from lakewarden.operators import sync as ops
from lakewarden.operators.report import run_counters
from lakewarden.session import shared_folder
from lakewarden.sinks.register import register_tables, unregister_tables


def plan_sync(catalog: DataFrame, targets: DataFrame, config: ops.SyncConfig) -> DataFrame:
    """Routed plan for the configured schemas, with registration requests. Nothing is changed.

    Targets that name their owners (``registered_tables``) are deleted by owner; a name without one is
    never deleted, but listed as a skip for the reason ``unknown owner`` if it looks like one of ours.
    """
    sources = ops.compose_targets(ops.select_schemas(catalog, config), config)
    owned = ops.owned_targets(targets, config).select("target")
    if not set(ops.OWNER) <= set(targets.columns):
        return ops.with_payload(ops.plan(sources, owned, config), config)
    unknown = ops.unknown_targets(targets, config)
    planned = ops.spare_unknown(ops.plan(sources, owned.unionByName(unknown), config), unknown)
    return ops.with_payload(planned, config)


@dataclass(frozen=True)
class SyncResult:
    plan: DataFrame
    outcomes: DataFrame
    counters: DataFrame
    plan_id: str


def sync_catalog(
    spark: SparkSession,
    catalog: DataFrame,
    targets: DataFrame,
    config: ops.SyncConfig,
    database: str,
    delete_orphans: bool = True,
    allow_empty_schemas: bool = False,
    plan_id: str | None = None,
    chunk: int = 10_000,
) -> SyncResult:
    """Plan, then drop orphaned registrations if enabled, then create the missing ones.

    The plan is written to the shared folder first, so that applying it cannot change it. A managed
    schema without any source table is an error unless ``allow_empty_schemas`` is set: its listing
    is more likely missing than empty, and every registration made for it would be dropped.

    Plan and outcomes are kept in the shared folder under ``plan_id``. A call with the id of a run that
    broke off goes on with that run's plan, after the last ``chunk`` of outcomes it wrote.
    """
    plan_id = plan_id or uuid.uuid4().hex
    folder = f"{shared_folder(spark)}/lakewarden/sync-{plan_id}"
    if not storage.exists(spark, f"{folder}/plan/_SUCCESS"):
        plan_sync(catalog, targets, config).write.mode("overwrite").parquet(f"{folder}/plan")
    planned = spark.read.parquet(f"{folder}/plan")
    if delete_orphans and not allow_empty_schemas:
        # At most one row per managed schema.
        listed = {row.schema_name for row in planned.select("schema_name").distinct().collect()}
        missing = sorted(set(config.schemas) - listed)
        if missing:
            raise ValueError(f"the catalog lists no table of {', '.join(missing)}")
    removed = None
    if delete_orphans:
        removed = unregister_tables(spark, planned, database, chunk=chunk, journal=f"{folder}/removed")
    outcomes = register_tables(spark, planned, database, chunk=chunk, journal=f"{folder}/created")
    if removed is not None:
        outcomes = removed.unionByName(outcomes)
    return SyncResult(planned, outcomes, run_counters(outcomes), plan_id)
