"""Outcomes of recorded attempts and the counts of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewarden.functions.registration import (
    classify_attempt,
    classify_removal,
    first_message,
    parse_response,
)


def with_outcome(attempts: DataFrame) -> DataFrame:
    """Recorded create attempts with the registered name, the message and the outcome."""
    message = first_message(F.col("body"))
    return attempts.select(
        "target",
        "attempt",
        "http_status",
        parse_response(F.col("body"))["name"].alias("registered_name"),
        message.alias("message"),
        classify_attempt(F.col("http_status"), message).alias("outcome"),
    )


def with_removal_outcome(attempts: DataFrame) -> DataFrame:
    """Recorded attempts to remove a registration with their outcome."""
    return attempts.withColumn("outcome", classify_removal(F.col("http_status")))


def final_outcomes(classified: DataFrame) -> DataFrame:
    """One outcome per target: its first ``created`` or ``skipped`` attempt, else ``failed``."""
    # Attempt number and outcome in one number, so that the aggregation stays hash-based.
    skipped = (F.col("outcome") == "skipped").cast("bigint")
    settled = F.when(F.col("outcome").isin("created", "skipped"), F.col("attempt") * 2 + skipped)
    first = classified.groupBy("target").agg(F.min(settled).alias("first"))
    outcome = (
        F.when(F.col("first").isNull(), F.lit("failed"))
        .when(F.pmod(F.col("first"), F.lit(2)) == 1, F.lit("skipped"))
        .otherwise(F.lit("created"))
    )
    return first.select("target", outcome.alias("outcome"))


def count_by(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def run_counters(outcomes: DataFrame) -> DataFrame:
    """One row: created, skipped, failed and deleted; ``failed`` covers creations and deletions."""

    def counted(*names: str) -> Column:
        return F.count_if(F.col("outcome").isin(*names))

    return outcomes.agg(
        counted("created").alias("created"),
        counted("skipped").alias("skipped"),
        counted("failed", "denied", "throttled").alias("failed"),
        counted("deleted").alias("deleted"),
    )
