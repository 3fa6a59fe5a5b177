"""Row types of the tables the toolkit reads and produces."""

from __future__ import annotations

from pyspark.sql import types as T

# The nine raw order columns, all text.
ORDER_COLUMNS = [
    "SalesOrderNumber",
    "SalesOrderLineNumber",
    "OrderDate",
    "CustomerName",
    "Email",
    "Item",
    "Quantity",
    "UnitPrice",
    "Tax",
]

ORDER_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in ORDER_COLUMNS])

# One row per object or folder below a storage root. Paths are relative to that root.
INVENTORY_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("is_dir", T.BooleanType()),
        T.StructField("length", T.LongType()),
        T.StructField("modified", T.TimestampType()),
    ]
)

# One row per table known to the source catalog.
CATALOG_SCHEMA = T.StructType(
    [
        T.StructField("catalog_name", T.StringType()),
        T.StructField("schema_name", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("table_type", T.StringType()),
        T.StructField("data_source_format", T.StringType()),
        T.StructField("storage_location", T.StringType()),
    ]
)

# A catalog listing response: one document holding the tables of one schema.
LISTING_SCHEMA = T.StructType([T.StructField("tables", T.ArrayType(CATALOG_SCHEMA))])

# Result of applying one plan row.
OUTCOME_SCHEMA = T.StructType(
    [
        T.StructField("target", T.StringType()),
        T.StructField("operation", T.StringType()),
        T.StructField("outcome", T.StringType()),
        T.StructField("message", T.StringType()),
    ]
)

# Table properties that say which source table's catalog and schema a registration belongs to.
CATALOG_PROPERTY, SCHEMA_PROPERTY = "lakewarden.catalog", "lakewarden.schema"

# Body of a registration response.
RESPONSE_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField(
            "moreDetails",
            T.ArrayType(T.StructType([T.StructField("message", T.StringType())])),
        ),
    ]
)
