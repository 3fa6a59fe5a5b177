"""Comparison of a source catalog with the registered names of a target."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewarden.functions.paths import location_to_https
from lakewarden.functions.registration import (
    NAME_PREFIX,
    TABLE_FORMAT,
    request_payload,
    route,
    tag_operation,
    target_name,
)
from lakewarden.operators.matching import drop_matching, flag_matching, keep_matching, one_row_per_key


@dataclass(frozen=True)
class SyncConfig:
    """What to keep in step.

    ``schemas`` are the managed schemas of ``catalog``. A registered name is a deletion candidate
    only if it starts with the composed prefix of a managed schema; names of other catalogs, other
    tools or no prefix are never touched. Because ``_`` may occur inside schema names, names alone let a
    managed schema ``a`` claim those of an unmanaged schema ``a_b``: list both in that case, or give
    targets with their owners (``registered_tables``), which then decide.

    ``object_urls_only`` requires locations to be object-store URLs; turn it off to register tables
    on any file system. ``fold_case`` lower-cases composed names, for target catalogs that do.
    """

    catalog: str
    schemas: tuple[str, ...]
    table_types: tuple[str, ...] = ("MANAGED",)
    table_format: str = TABLE_FORMAT
    connection_id: str = ""
    object_urls_only: bool = True
    fold_case: bool = False

    def __post_init__(self) -> None:
        if not self.schemas:
            raise ValueError("at least one schema is needed")

    def owns(self, target: Column) -> Column:
        """True for names this configuration may delete."""
        start, schemas = f"{NAME_PREFIX}_{self.catalog}_", self.schemas
        if self.fold_case:
            start, schemas = start.lower(), [schema.lower() for schema in schemas]
        # The schema is what stands before one of the underscores: each such beginning is looked up in
        # the set of schemas, so the number of schemas does not matter. The plain prefix can be pushed
        # into a scan.
        parts = F.split(F.substr(target, F.lit(len(start) + 1)), "_")
        begins = F.filter(F.sequence(F.lit(0), F.size(parts) - 1), lambda i: i > 0)
        known = F.exists(begins, lambda i: F.array_join(F.slice(parts, F.lit(1), i), "_").isin(*schemas))
        return target.startswith(start) & known


def union_listings(listings: Iterable[DataFrame]) -> DataFrame:
    """All rows of the per-schema listings, duplicates kept."""
    return reduce(DataFrame.unionByName, listings)


def union_partitions(listings: DataFrame, config: SyncConfig, partition: str) -> DataFrame:
    """All rows of listings that lie side by side, one partition per schema, in one scan of the configured ones.

    A listing holds its own schema only; rows of another that stand in it are not taken.
    """
    chosen = F.col(partition).isin(*config.schemas) & (F.col(partition) == F.col("schema_name"))
    return select_schemas(listings.where(chosen), config).drop(partition)


def select_schemas(catalog: DataFrame, config: SyncConfig) -> DataFrame:
    """Tables of the configured schemas of the configured catalog."""
    chosen = (F.col("catalog_name") == config.catalog) & F.col("schema_name").isin(*config.schemas)
    return catalog.where(chosen)


def compose_targets(catalog: DataFrame, config: SyncConfig) -> DataFrame:
    """Add the name each source table gets in the target."""
    name = target_name(F.col("catalog_name"), F.col("schema_name"), F.col("name"))
    return catalog.withColumn("target", F.lower(name) if config.fold_case else name)


OWNER = ("catalog_name", "schema_name")


def owned_targets(targets: DataFrame, config: SyncConfig) -> DataFrame:
    """The registered names this configuration may delete.

    Where the targets name their owners, the owner decides, and of a name without owner nothing is known.
    """
    if config.fold_case:
        targets = targets.withColumn("target", F.lower("target"))
    if not set(OWNER) <= set(targets.columns):
        return targets.where(config.owns(F.col("target")))
    return targets.where((F.col("catalog_name") == config.catalog) & F.col("schema_name").isin(*config.schemas))


def unknown_targets(targets: DataFrame, config: SyncConfig) -> DataFrame:
    """Registered names that look like this configuration's, but do not name an owner. Only where others do."""
    if not set(OWNER) <= set(targets.columns):
        return targets.select("target").limit(0)
    if config.fold_case:
        targets = targets.withColumn("target", F.lower("target"))
    nobody = F.col("catalog_name").isNull() | F.col("schema_name").isNull()
    return targets.where(nobody & config.owns(F.col("target"))).select("target")


def spare_unknown(planned: DataFrame, unknown: DataFrame) -> DataFrame:
    """The plan with names of unknown owner skipped instead of deleted."""
    flagged = flag_matching(planned, unknown, "target", "_unknown")
    spared = (F.col("operation") == "delete") & F.col("_unknown")
    reason = F.when(spared, "unknown owner").otherwise(F.col("reason"))
    operation = F.when(spared, "skip").otherwise(F.col("operation"))
    return flagged.withColumn("reason", reason).withColumn("operation", operation).drop("_unknown")


def still_present(targets: DataFrame, sources: DataFrame) -> DataFrame:
    """Registered names that still have a source table."""
    return keep_matching(targets, sources, "target")


def to_delete(targets: DataFrame, sources: DataFrame) -> DataFrame:
    """Registered names without a source table."""
    return drop_matching(targets, sources, "target")


def to_create(sources: DataFrame, targets: DataFrame) -> DataFrame:
    """Source tables without a registered name; a table whose name cannot be composed is none."""
    return drop_matching(sources.where(F.col("target").isNotNull()), targets, "target")


def name_status(sources: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per name on either side: ``in_source``, ``in_target``, ``ambiguous``.

    This is the full outer join of the two name sets written as one aggregation of their union. It
    shuffles each name once, and a name repeated on either side is combined before the shuffle; a
    full outer join could not be split if one name dominated.
    """
    # Two tables share a name only if they cut it at different places or, with folded case, spell it
    # differently. Numbers keep the aggregation hash-based.
    cut = F.length("catalog_name") * F.lit(1 << 31).cast("bigint") + F.length("schema_name")
    spelling = F.xxhash64("catalog_name", "schema_name", "name")
    names = sources.select("target", F.lit(True).alias("in_source"), cut.alias("cut"), spelling.alias("spelling"))
    nothing = F.lit(None).cast("bigint")
    names = names.unionAll(targets.select("target", F.lit(False), nothing, nothing))
    status = one_row_per_key(
        names,
        "target",
        F.bool_or("in_source").alias("in_source"),
        F.bool_or(~F.col("in_source")).alias("in_target"),
        (F.min("cut") != F.max("cut")).alias("cuts_differ"),
        (F.min("spelling") != F.max("spelling")).alias("spellings_differ"),
    )
    ambiguous = F.coalesce(F.col("cuts_differ") | F.col("spellings_differ"), F.lit(False))
    return status.select("target", "in_source", "in_target", ambiguous.alias("ambiguous"))


def diff(sources: DataFrame, targets: DataFrame) -> DataFrame:
    """Every name on either side with exactly one of ``create``, ``delete`` and ``skip``."""
    operation = F.when(~F.col("in_source"), F.lit("delete")).otherwise(tag_operation(~F.col("in_target")))
    return name_status(sources, targets).select("target", operation.alias("operation"))


def plan(sources: DataFrame, targets: DataFrame, config: SyncConfig) -> DataFrame:
    """What to do with every source table and every orphaned name.

    One row per source table (``create``, ``skip`` or ``conflict``) and one per name to ``delete``.
    A name composed from different tables is a conflict for all of them unless it is registered
    already. A source table whose name cannot be composed is skipped.
    """
    status = name_status(sources, targets)
    known = status.where("in_source").select("target", "in_target", "ambiguous")
    rows = sources.join(known, "target", "left")

    parsed = location_to_https(F.col("storage_location"))
    location_ok = parsed.isNotNull() if config.object_urls_only else F.col("storage_location").isNotNull()
    decision = F.when(
        F.col("target").isNull(),
        F.struct(F.lit("skip").alias("operation"), F.lit("name").alias("reason")),
    ).otherwise(
        route(
            registered=F.coalesce(F.col("in_target"), F.lit(False)),
            conflict=F.coalesce(F.col("ambiguous"), F.lit(False)),
            table_type=F.col("table_type"),
            table_format=F.col("data_source_format"),
            location_ok=location_ok,
            table_types=config.table_types,
            supported_format=config.table_format,
        )
    )
    routed = rows.select(
        "target",
        "catalog_name",
        "schema_name",
        decision.alias("decision"),
        parsed["https"].alias("location"),
        parsed["subpath"].alias("subpath"),
        "storage_location",
        "data_source_format",
    ).select(
        "target",
        "catalog_name",
        "schema_name",
        "decision.operation",
        "decision.reason",
        "location",
        "subpath",
        "storage_location",
        "data_source_format",
    )
    # Filtering on all three flags keeps this branch equal to the one above, so its shuffle is reused.
    orphaned = F.col("in_target") & ~F.col("in_source") & ~F.col("ambiguous")
    orphans = status.where(orphaned).select(
        "target",
        F.lit("delete").alias("operation"),
        F.lit("gone").alias("reason"),
    )
    return routed.unionByName(orphans, allowMissingColumns=True)


def with_payload(planned: DataFrame, config: SyncConfig) -> DataFrame:
    """Add the registration request of each ``create`` row."""
    payload = request_payload(F.col("target"), F.col("location"), F.col("subpath"), config.connection_id)
    wanted = (F.col("operation") == "create") & F.col("location").isNotNull()
    return planned.withColumn("payload", F.when(wanted, payload))
