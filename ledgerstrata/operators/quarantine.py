"""Rejected rows: per entity, united, and summarised."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstrata import schemas as S


def quarantine_accounts(classified: DataFrame, run_id: str, now: datetime) -> DataFrame:
    """The complement of promotion: raw fields, reason and rejection time."""
    return classified.where(F.col("_rejection_reason").isNotNull()).select(
        *S.ACCOUNT_SOURCE.names,
        "_source_file",
        F.lit(run_id).alias("_pipeline_run_id"),
        F.lit(now).cast("timestamp").alias("_rejected_at"),
        "_rejection_reason",
        "date",
    )


def quarantine_all(transactions: DataFrame | None, accounts: DataFrame | None) -> DataFrame:
    """All rejects by column name; a field an entity lacks is NULL.

    The schema is always that of both entities, whichever of them has rejects yet.
    """
    spark = SparkSession.active()
    if transactions is None:
        transactions = spark.createDataFrame([], S.QUARANTINE_TRANSACTIONS)
    if accounts is None:
        accounts = spark.createDataFrame([], S.QUARANTINE_ACCOUNTS)
    named = [
        rows.withColumn("entity", F.lit(entity))
        for entity, rows in (("transactions", transactions), ("accounts", accounts))
    ]
    return named[0].unionByName(named[1], allowMissingColumns=True)


def rejection_summary(rejects: DataFrame) -> DataFrame:
    """Rejects by date and reason."""
    return rejects.groupBy("date", "_rejection_reason").agg(F.count("*").alias("rejected_rows"))
