"""Run log and processing-date watermark: append-only state, read as tables."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstrata import schemas as S
from ledgerstrata.functions.rules import any_of
from ledgerstrata.functions.scalars import scrub_error
from ledgerstrata.sources.journal import Journal
from ledgerstrata.sources.tables import replace_table, scan_table, small_table

# Models that must have succeeded before a date counts as fully processed.
WATERMARK_MODELS = ("silver_transactions", "gold_daily_summary", "gold_weekly_account_summary")


# ---------------------------------------------------------------------------
# Run log
# ---------------------------------------------------------------------------
def sanitize_errors(log: DataFrame) -> DataFrame:
    return log.withColumn("error_message", scrub_error(F.col("error_message")))


def append_run_log(rows: DataFrame, path: str) -> None:
    """Append attempts; a row without a required field fails the whole append."""
    missing = any_of(F.col(name).isNull() for name in S.RUN_LOG_REQUIRED)
    bad = rows.where(missing).select(*S.RUN_LOG_REQUIRED).first()
    if bad is not None:
        empty = [name for name in S.RUN_LOG_REQUIRED if bad[name] is None]
        raise ValueError(f"run log fields must not be null: {', '.join(empty)}")
    journal(rows.sparkSession, path).append(sanitize_errors(rows))


def journal(spark: SparkSession, path: str) -> Journal:
    """The log as a folder of entries by month."""
    return Journal(spark, path, S.RUN_LOG, "started_at")


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """Every attempt, oldest first; empty while nothing was logged.

    Files that cannot be read are left out; `journal(…).broken()` names them.
    """
    return journal(spark, path).rows().orderBy("started_at")


def latest_attempts(log: DataFrame) -> DataFrame:
    """The newest attempt of every model and processing date; it alone decides."""
    keys = ["model_name", "processing_date"]
    payload = ["completed_at", "started_at"]
    payload += [c for c in log.columns if c not in keys + payload]
    newest = F.max(F.struct(*payload)).alias("newest")
    return log.groupBy(*keys).agg(newest).select(*keys, "newest.*").select(*log.columns)


def accounts_ready(log: DataFrame) -> DataFrame:
    """Per processing date: are Silver accounts at least as new as Bronze accounts?"""

    def latest(model: str, *statuses: str):
        done = (F.col("model_name") == model) & F.col("status").isin(*statuses)
        return F.max(F.when(done, F.col("completed_at")))

    silver = latest("silver_accounts", S.SUCCESS)
    bronze = latest("bronze_accounts", S.SUCCESS, S.SKIPPED)
    return log.groupBy("processing_date").agg(
        F.coalesce(silver >= bronze, F.lit(False)).alias("accounts_ready")
    )


def succeeded_dates(log: DataFrame, *models: str) -> DataFrame:
    """Dates whose latest attempt of every named model succeeded."""
    succeeded = F.col("status") == S.SUCCESS
    return (
        latest_attempts(log.where(F.col("model_name").isin(*models)))
        .groupBy(F.col("processing_date").alias("date"))
        .agg(F.count_if(succeeded).alias("n"))
        .where(F.col("n") == len(models))
        .select("date")
    )


def watermark_from_log(log: DataFrame) -> DataFrame:
    """One row: the last date before the first one not fully processed.

    Days between logged dates count too: a day nobody logged is a gap. The row is
    NULL while even the first date is open.
    """
    logged = log.agg(
        F.min("processing_date").alias("first"), F.max("processing_date").alias("last")
    ).where(F.col("first").isNotNull())
    days = logged.select("last", F.explode(F.sequence("first", "last")).alias("date"))
    done = succeeded_dates(log, *WATERMARK_MODELS).withColumn("done", F.lit(True))
    days = days.join(done, "date", "left")
    first_open = F.min(F.when(F.col("done").isNull(), F.col("date")))
    return days.agg(
        F.coalesce(F.date_sub(first_open, 1), F.max("last")).alias("mark"),
        F.min("date").alias("first"),
    ).select(F.when(F.col("mark") >= F.col("first"), F.col("mark")).alias("last_processed_date"))


# ---------------------------------------------------------------------------
# Control table
# ---------------------------------------------------------------------------
def parse_day(text: str) -> date:
    if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", text):
        raise ValueError(f"not a YYYY-MM-DD date: {text!r}")
    return date.fromisoformat(text)


def write_watermark(
    spark: SparkSession, path: str, day: str | date, run_id: str, now: datetime
) -> None:
    """Overwrite the one-row control table."""
    day = parse_day(day) if isinstance(day, str) else day
    replace_table(small_table(spark, [(day, now, run_id)], S.CONTROL), path)


def read_watermark(spark: SparkSession, path: str) -> date | None:
    """The last processed date; None before the first run."""
    rows = scan_table(spark, path, S.CONTROL).limit(2).collect()
    if len(rows) > 1:
        raise ValueError("the control table must hold exactly one row")
    return rows[0]["last_processed_date"] if rows else None


def next_date(control: DataFrame) -> DataFrame:
    """The date after the watermark."""
    return control.select(F.date_add("last_processed_date", 1).alias("next_date"))


def require_next_date(spark: SparkSession, path: str) -> date:
    mark = read_watermark(spark, path)
    if mark is None:
        raise RuntimeError("an incremental run needs a finished historical run first")
    return mark + timedelta(days=1)
