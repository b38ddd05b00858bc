"""Account deltas: classification, newest-wins snapshot, first sighting."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerstrata import schemas as S
from ledgerstrata.functions.rules import account_rules, as_day, as_money, first_match


def classify_accounts(bronze: DataFrame) -> DataFrame:
    """Bronze deltas with `_rejection_reason`; NULL means the delta passes."""
    return bronze.withColumn("_rejection_reason", first_match(account_rules()))


def passing_accounts(classified: DataFrame) -> DataFrame:
    """Typed deltas that passed every rule."""
    return (
        classified.where(F.col("_rejection_reason").isNull())
        .drop("_rejection_reason")
        .withColumns(
            {
                "credit_limit": as_money("credit_limit"),
                "current_balance": as_money("current_balance"),
                "open_date": as_day("open_date"),
                "billing_cycle_start": as_day("billing_cycle_start"),
                "billing_cycle_end": as_day("billing_cycle_end"),
            }
        )
    )


def newest_per_account(passing: DataFrame) -> DataFrame:
    """One row per account: the delta of the latest date.

    The latest dates come from a hash aggregate of fixed-width values, which folds inside
    each task; only rows of these dates go on. Two deltas of one account and date are told
    apart by their content, greatest first, and every task hands on its own first one only.
    """
    last = passing.groupBy("account_id").agg(F.max("date").alias("date"))
    content = [c for c in passing.columns if c not in ("date", "account_id")]
    place = F.row_number().over(Window.partitionBy("account_id").orderBy(*map(F.desc, content)))
    newest = passing.join(last, ["account_id", "date"], "left_semi").withColumn("_place", place)
    return newest.where(F.col("_place") == 1).select("account_id", "date", *content)


def silver_accounts(passing: DataFrame, run_id: str, now: datetime) -> DataFrame:
    """The snapshot table: newest passing delta of every account ever seen."""
    return (
        newest_per_account(passing.drop("_pipeline_run_id"))
        .withColumnRenamed("_ingested_at", "_bronze_ingested_at")
        .withColumns(
            {
                "_pipeline_run_id": F.lit(run_id),
                "_record_valid_from": F.lit(now).cast("timestamp"),
            }
        )
        .select(*S.SILVER_ACCOUNTS.names)
    )


def keep_stamps(rebuilt: DataFrame, stored: DataFrame) -> DataFrame:
    """A rebuilt snapshot with the audit values of the stored rows that have not changed."""
    stamps = ("_pipeline_run_id", "_record_valid_from")
    content = [c for c in rebuilt.columns if c not in (*stamps, "account_id")]
    old = stored.select("account_id", *[F.col(c).alias(f"_old_{c}") for c in (*content, *stamps)])
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_old_{c}")) for c in content])
    kept = {c: F.when(same, F.col(f"_old_{c}")).otherwise(F.col(c)) for c in stamps}
    return rebuilt.join(old, "account_id", "left").withColumns(kept).select(*rebuilt.columns)


def upsert_accounts(snapshot: DataFrame, delta: DataFrame) -> DataFrame:
    """Replace the snapshot rows a one-row-per-account delta brings anew."""
    kept = snapshot.join(delta.select("account_id"), "account_id", "left_anti")
    return kept.unionByName(delta)


def first_sightings(passing: DataFrame) -> DataFrame:
    """Date from which each account counts as known; accounts never leave."""
    return passing.groupBy("account_id").agg(F.min("date").alias("known_from"))
