"""Bronze landing: raw rows, audit columns and the per-date load plan."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WRITE, SKIP, REWRITE = "WRITE", "SKIP", "REWRITE"


def with_bronze_audit(rows: DataFrame, run_id: str, now: datetime) -> DataFrame:
    """Source fields untouched, plus ingestion time and run id.

    The time is fixed once per run, so a retried task writes the same value.
    """
    return rows.withColumns(
        {"_ingested_at": F.lit(now).cast("timestamp"), "_pipeline_run_id": F.lit(run_id)}
    )


def rows_per_date(rows: DataFrame, name: str) -> DataFrame:
    return rows.groupBy("date").agg(F.count("*").alias(name))


def load_plan(source_rows: DataFrame, bronze_rows: DataFrame) -> DataFrame:
    """Decide per date from (date, source_rows) and (date, bronze_rows).

    Equal counts: the date is done. Different counts: an earlier load broke off,
    so the date is rewritten. Dates only Bronze knows are left alone. If `bronze_rows`
    says whether a date is `sound`, one that is not is rewritten, whatever its count.
    """
    unsound = ~F.col("sound") if "sound" in bronze_rows.columns else F.lit(False)
    action = (
        F.when(unsound, REWRITE)
        .when(F.col("bronze_rows").isNull(), WRITE)
        .when(F.col("source_rows").isNull(), SKIP)
        .when(F.col("source_rows") == F.col("bronze_rows"), SKIP)
        .otherwise(REWRITE)
    )
    return source_rows.join(bronze_rows, "date", "full_outer").select(
        "date", "source_rows", "bronze_rows", action.alias("action")
    )
