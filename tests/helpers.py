"""Small inputs and plan inspection shared by the tests."""

from pyspark.sql import functions as F

from lakewarden.schemas import CATALOG_SCHEMA


def inventory_of(spark, files=None, folders=()):
    """Inventory rows from ``{path: length}`` and folder paths."""
    rows = [(path, False, length) for path, length in (files or {}).items()]
    rows += [(path, True, 0) for path in folders]
    return spark.createDataFrame(rows, "path string, is_dir boolean, length bigint")


def catalog_of(spark, *rows):
    return spark.createDataFrame(list(rows), CATALOG_SCHEMA)


def targets_of(spark, *names):
    return spark.createDataFrame([(name,) for name in names], "target string")


def one(spark, column, **values):
    """Evaluate a column over one row of string (or other simple) values."""
    row = spark.range(1).select(*[F.lit(value).alias(name) for name, value in values.items()])
    return row.select(column.alias("result")).first()["result"]


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan_text(df):
    """The adaptive plan after it ran."""
    df.collect()
    return plan_text(df).split("== Initial Plan ==")[0]
