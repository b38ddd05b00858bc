"""Gold summaries, always computed from Silver tables alone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerstrata import schemas as S
from ledgerstrata.functions.scalars import (
    gold_money,
    gold_money_or_zero,
    sum_when,
    week_end,
    week_start,
)
from ledgerstrata.operators.codes import code_lookup


def _type_columns(kind: str) -> tuple[str, str]:
    return f"{kind.lower()}_count", f"{kind.lower()}_sum"


def daily_partials(silver: DataFrame, *keys: str) -> DataFrame:
    """Counts and sums per transaction date and code, and per `keys` if given.

    Partials of different days can be folded together in any order. Dates with
    unresolvable rows only are there with zeros: the conditions sit inside the aggregates.
    """
    counted = F.col("_is_resolvable")
    return silver.groupBy("transaction_date", "transaction_code", *keys).agg(
        F.count_if(counted).alias("n"),
        sum_when(counted, F.col("_signed_amount")).cast(S.PARTIAL_MONEY).alias("signed"),
        F.count_if(counted & (F.col("channel") == "ONLINE")).alias("online"),
        F.count_if(counted & (F.col("channel") == "IN_STORE")).alias("instore"),
    )


def fold_daily(partials: DataFrame, codes: DataFrame) -> DataFrame:
    """The daily figures from partials, flat; the codes meet a handful of rows per date."""
    kind = F.col("transaction_type")
    by_type = []
    for name in S.TRANSACTION_TYPES:
        count_name, sum_name = _type_columns(name)
        by_type.append(F.coalesce(sum_when(kind == name, F.col("n")), F.lit(0)).cast("long").alias(count_name))
        by_type.append(gold_money_or_zero(sum_when(kind == name, F.col("signed"))).alias(sum_name))
    return (
        partials.join(code_lookup(codes, "transaction_type"), "transaction_code", "left")
        .groupBy("transaction_date")
        .agg(
            F.sum("n").alias("total_transactions"),
            gold_money_or_zero(F.sum("signed")).alias("total_signed_amount"),
            *by_type,
            F.sum("online").alias("online_transactions"),
            F.sum("instore").alias("instore_transactions"),
        )
    )


def daily_totals(silver: DataFrame, codes: DataFrame) -> DataFrame:
    """Counts and sums per `transaction_date`, flat.

    Every date present in Silver gets a row, without a second scan for the dates. Rows
    are folded per date and code before the code lookup.
    """
    return fold_daily(daily_partials(silver), codes)


def with_source_period(daily: DataFrame) -> DataFrame:
    """Add the first and last Silver date to every row.

    `daily` has a row for every date of Silver, so its own dates say it without another
    scan; the window holds one row per date.
    """
    day, everything = F.col("transaction_date"), Window.partitionBy()
    return daily.withColumns(
        {
            "_source_period_start": F.min(day).over(everything),
            "_source_period_end": F.max(day).over(everything),
        }
    )


def gold_daily_summary(
    silver: DataFrame, codes: DataFrame, run_id: str, now: datetime
) -> DataFrame:
    return daily_table(daily_totals(silver, codes), run_id, now)


def daily_table(daily: DataFrame, run_id: str, now: datetime) -> DataFrame:
    """The daily table from its figures, with one nested entry per transaction type."""
    cells = []
    for name in S.TRANSACTION_TYPES:
        count_name, sum_name = _type_columns(name)
        cells.append(
            F.struct(F.col(count_name).alias("count"), F.col(sum_name).alias("sum")).alias(name)
        )
    return (
        with_source_period(daily)
        .withColumns(
            {
                "transactions_by_type": F.struct(*cells),
                "_computed_at": F.lit(now).cast("timestamp"),
                "_pipeline_run_id": F.lit(run_id),
            }
        )
        .select(*S.GOLD_DAILY.names)
    )


def weekly_partials(silver: DataFrame, *keys: str) -> DataFrame:
    """Counts and sums of resolvable rows per week, account and code, and per `keys`."""
    week = week_start(F.col("transaction_date")).alias("week_start_date")
    return silver.where(F.col("_is_resolvable")).groupBy(week, "account_id", "transaction_code", *keys).agg(
        F.count("*").alias("n"), F.sum("_signed_amount").cast(S.PARTIAL_MONEY).alias("signed")
    )


def fold_weekly(partials: DataFrame, codes: DataFrame) -> DataFrame:
    """Totals per ISO week and account from partials.

    Sums are 0 where nothing matched; the mean stays NULL, since 0 would read as
    a real purchase.
    """
    kind, signed, day = F.col("transaction_type"), F.col("signed"), F.col("week_start_date")
    purchases = F.coalesce(sum_when(kind == "PURCHASE", F.col("n")), F.lit(0))
    # Decimal division: the mean does not depend on the order of the sum.
    mean = sum_when(kind == "PURCHASE", signed).cast(S.PARTIAL_MONEY) / F.nullif(purchases, F.lit(0))
    return (
        partials.join(code_lookup(codes, "transaction_type"), "transaction_code", "left")
        .groupBy("week_start_date", week_end(day).alias("week_end_date"), "account_id")
        .agg(
            purchases.alias("total_purchases"),
            gold_money(mean).alias("avg_purchase_amount"),
            gold_money_or_zero(sum_when(kind == "PAYMENT", signed)).alias("total_payments"),
            gold_money_or_zero(sum_when(kind == "FEE", signed)).alias("total_fees"),
            gold_money_or_zero(sum_when(kind == "INTEREST", signed)).alias("total_interest"),
        )
    )


def weekly_totals(silver: DataFrame, codes: DataFrame) -> DataFrame:
    """Totals per ISO week and account over resolvable rows."""
    return fold_weekly(weekly_partials(silver), codes)


def gold_weekly_account_summary(
    silver: DataFrame, codes: DataFrame, accounts: DataFrame, run_id: str, now: datetime
) -> DataFrame:
    return weekly_table(weekly_totals(silver, codes), accounts, run_id, now)


def weekly_table(weekly: DataFrame, accounts: DataFrame, run_id: str, now: datetime) -> DataFrame:
    """The weekly table from its figures; `closing_balance` is the account's latest balance."""
    balances = accounts.select(
        "account_id", gold_money(F.col("current_balance")).alias("closing_balance")
    )
    return (
        weekly.join(balances, "account_id", "left")
        .withColumns(
            {"_computed_at": F.lit(now).cast("timestamp"), "_pipeline_run_id": F.lit(run_id)}
        )
        .select(*S.GOLD_WEEKLY.names)
    )
