"""Table registration: names, routing, request payloads and response classification."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakewarden.schemas import RESPONSE_SCHEMA

# The name prefix, the table format registered by default, the default error text, and the
# two response messages that decide an attempt's outcome.
NAME_PREFIX = "uc"
TABLE_FORMAT = "DELTA"
NO_MESSAGE = "No error message found"
ALREADY_REGISTERED_MESSAGE = "Copy, Rename or Update of shortcuts are not supported by OneLake."
ACCESS_DENIED_TEXT = "Unauthorized. Access to target location"

# HTTP status codes of registration responses.
HTTP_OK = [200, 201]
HTTP_BAD_REQUEST = 400
HTTP_FORBIDDEN = 403
HTTP_NOT_FOUND = 404
HTTP_THROTTLED = 429


def target_name(catalog: Column, schema: Column, table: Column) -> Column:
    """``uc_<catalog>_<schema>_<table>``; null if any part is null."""
    separator = F.lit("_")
    return F.concat(F.lit(NAME_PREFIX), separator, catalog, separator, schema, separator, table)


def tag_operation(is_missing: Column) -> Column:
    """``create`` for a source table the target lacks, else ``skip``."""
    return F.when(is_missing, F.lit("create")).otherwise(F.lit("skip"))


def route(
    *,
    registered: Column,
    conflict: Column,
    table_type: Column,
    table_format: Column,
    location_ok: Column,
    table_types: Sequence[str],
    supported_format: str = TABLE_FORMAT,
) -> Column:
    """struct(operation, reason): the first rule that applies decides.

    ``registered`` and ``conflict`` are non-null booleans; a null type or format never qualifies.
    """
    has_type = F.coalesce(table_type.isin(*table_types), F.lit(False))
    has_format = table_format.eqNullSafe(F.lit(supported_format))

    def decision(operation: str, reason: Column) -> Column:
        return F.struct(F.lit(operation).alias("operation"), reason.alias("reason"))

    def naming(kind: str, value: Column) -> Column:
        return F.concat(F.lit(f"{kind}:"), F.coalesce(value, F.lit("unknown")))

    return (
        F.when(registered, decision("skip", F.lit("exists")))
        .when(conflict, decision("conflict", F.lit("ambiguous name")))
        .when(~has_type, decision("skip", naming("type", table_type)))
        .when(~has_format, decision("skip", naming("format", table_format)))
        .when(~location_ok, decision("skip", F.lit("location")))
        .otherwise(decision("create", F.lit("new")))
    )


def request_payload(target: Column, location: Column, subpath: Column, connection_id: str) -> Column:
    """The JSON document that asks for a zero-copy registration."""
    # The field names and the path of the request.
    store = F.struct(
        location.alias("location"),
        subpath.alias("subpath"),
        F.lit(connection_id).alias("connectionId"),
    )
    return F.to_json(
        F.struct(
            F.lit("Tables").alias("path"),
            target.alias("name"),
            F.struct(store.alias("adlsGen2")).alias("target"),
        )
    )


def parse_response(body: Column) -> Column:
    """Response text -> struct(name, moreDetails); null fields if it is malformed."""
    return F.from_json(body, RESPONSE_SCHEMA)


def first_message(body: Column) -> Column:
    """The first error message of a response, or a fixed text if it has none."""
    return F.coalesce(F.get_json_object(body, "$.moreDetails[0].message"), F.lit(NO_MESSAGE))


def classify_attempt(status: Column, message: Column) -> Column:
    """Outcome of one recorded attempt to create a registration."""
    rejected = status == HTTP_BAD_REQUEST
    return (
        F.when(status.isin(HTTP_OK), F.lit("created"))
        .when(status == HTTP_THROTTLED, F.lit("throttled"))
        .when(rejected & (message == ALREADY_REGISTERED_MESSAGE), F.lit("skipped"))
        .when(rejected & message.contains(ACCESS_DENIED_TEXT), F.lit("denied"))
        .when(status == HTTP_FORBIDDEN, F.lit("denied"))
        .otherwise(F.lit("failed"))
    )


def classify_removal(status: Column) -> Column:
    """Outcome of one recorded attempt to remove a registration."""
    return (
        F.when(status == 200, F.lit("deleted"))
        .when(status == HTTP_NOT_FOUND, F.lit("already_absent"))
        .when(status == HTTP_THROTTLED, F.lit("throttled"))
        .otherwise(F.lit("failed"))
    )
