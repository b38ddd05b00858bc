"""Transaction codes: the reference side of every code lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def silver_transaction_codes(bronze_codes: DataFrame, run_id: str) -> DataFrame:
    """Carry every Bronze code over with its audit columns renamed."""
    return (
        bronze_codes.drop("_pipeline_run_id")
        .withColumnRenamed("_ingested_at", "_bronze_ingested_at")
        .withColumn("affects_balance", F.col("affects_balance").try_cast("boolean"))
        .withColumn("_pipeline_run_id", F.lit(run_id))
    )


def code_lookup(codes: DataFrame, attribute: str) -> DataFrame:
    """One row per code, so that a repeated code cannot multiply transactions."""
    return codes.groupBy("transaction_code").agg(F.max(attribute).alias(attribute))
