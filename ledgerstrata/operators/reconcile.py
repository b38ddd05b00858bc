"""Conservation of rows between layers, promotion gate, run comparison."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstrata.operators.bronze import rows_per_date


def reconcile(bronze: DataFrame, silver: DataFrame, rejects: DataFrame) -> DataFrame:
    """Per date: bronze, silver and quarantine counts, and what is unaccounted for.

    On written tables the counts come from partition folders and file footers.
    """
    return reconcile_counts(*(rows_per_date(rows, "rows") for rows in (bronze, silver, rejects)))


def reconcile_counts(bronze: DataFrame, silver: DataFrame, rejects: DataFrame) -> DataFrame:
    """`reconcile` from rows that say how many `rows` a `date` has, such as manifests."""
    counts = ("bronze_rows", "silver_rows", "quarantine_rows")
    sides = [
        table.select("date", F.col("rows").alias(name))
        for table, name in zip((bronze, silver, rejects), counts)
    ]
    joined = sides[0].join(sides[1], "date", "full_outer").join(sides[2], "date", "full_outer")
    filled = joined.select("date", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts])
    delta = F.col("bronze_rows") - F.col("silver_rows") - F.col("quarantine_rows")
    return filled.withColumn("delta", delta)


def reconcile_total(reconciliation: DataFrame) -> DataFrame:
    columns = ("bronze_rows", "silver_rows", "quarantine_rows", "delta")
    return reconciliation.agg(*[F.sum(c).alias(c) for c in columns])


def promotion_gate(reconciliation: DataFrame) -> DataFrame:
    """Dates allowed into Gold: every Bronze row is in Silver or in quarantine."""
    return reconciliation.where(F.col("delta") == 0).select("date")


def gated(silver: DataFrame, allowed_dates: DataFrame) -> DataFrame:
    return silver.join(allowed_dates, "date", "left_semi")


def _row_count(rows: DataFrame, metric: str) -> DataFrame:
    value = F.count("*").cast("decimal(38,3)").alias("value")
    return rows.agg(value).select(F.lit(metric).alias("metric"), "value")


def layer_metrics(
    bronze_transactions: DataFrame,
    bronze_accounts: DataFrame,
    bronze_codes: DataFrame,
    silver_transactions: DataFrame,
    silver_accounts: DataFrame,
    rejects: DataFrame,
    gold_daily: DataFrame,
    gold_weekly: DataFrame,
    control: DataFrame,
) -> DataFrame:
    """Ten numbers that must not change when a run is repeated.

    The watermark is given as days since 1970-01-01, so all values share a type.
    """
    signed = F.sum("total_signed_amount").cast("decimal(38,3)").alias("value")
    mark = F.max(F.unix_date("last_processed_date")).cast("decimal(38,3)").alias("value")
    parts = [
        _row_count(bronze_transactions, "bronze_transactions"),
        _row_count(bronze_accounts, "bronze_accounts"),
        _row_count(bronze_codes, "bronze_transaction_codes"),
        _row_count(silver_transactions, "silver_transactions"),
        _row_count(silver_accounts, "silver_accounts"),
        _row_count(rejects, "quarantine"),
        _row_count(gold_daily, "gold_daily_summary"),
        gold_daily.agg(signed).select(F.lit("gold_daily_signed_sum").alias("metric"), "value"),
        _row_count(gold_weekly, "gold_weekly_account_summary"),
        control.agg(mark).select(F.lit("watermark").alias("metric"), "value"),
    ]
    return reduce(DataFrame.unionByName, parts)


def compare_metrics(first: DataFrame, second: DataFrame) -> DataFrame:
    """Metrics that differ between two runs; a metric only one run has differs."""
    a = first.select("metric", F.col("value").alias("first_value"))
    b = second.select("metric", F.col("value").alias("second_value"))
    return a.join(b, "metric", "full_outer").where(
        ~F.col("first_value").eqNullSafe(F.col("second_value"))
    )
