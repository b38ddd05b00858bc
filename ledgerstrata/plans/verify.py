"""All data-quality checks over a lake."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstrata import schemas as S
from ledgerstrata.operators import checks as CK
from ledgerstrata.operators import reconcile as RC
from ledgerstrata.operators import runlog as RL
from ledgerstrata.plans.lake import Lake
from ledgerstrata.sources import extracts as EX


def lake_metrics(lake: Lake) -> DataFrame:
    """The ten metrics two runs over one input must agree on."""
    return RC.layer_metrics(
        lake.bronze("transactions"),
        lake.bronze("accounts"),
        lake.bronze_codes(),
        lake.silver_transactions(),
        lake.silver_accounts(),
        lake.quarantine(),
        lake.gold_daily(),
        lake.gold_weekly(),
        lake.control(),
    )


def _extract_rows(lake: Lake, entity: str, last: date) -> DataFrame:
    schema = {"transactions": S.TRANSACTION_SOURCE, "accounts": S.ACCOUNT_SOURCE}[entity]
    files = EX.list_extracts(lake.spark, lake.source, entity).where(F.col("date") <= F.lit(last))
    return EX.scan_extracts(lake.spark, [row["path"] for row in files.collect()], schema, lake.multi_line)


def lake_checks(lake: Lake, last: date, earlier_metrics: DataFrame | None = None) -> DataFrame:
    """(check_id, violations) for every check; all zero on a sound lake.

    `last` is the date the lake should stand at. `earlier_metrics` are the stored
    metrics of a run before a repeat; without them I-01 is left out. A table that
    is missing makes `EXISTS-…` count a violation instead of passing the rest.
    """
    transactions, accounts = lake.bronze("transactions"), lake.bronze("accounts")
    bronze_codes, codes = lake.bronze_codes(), lake.silver_codes()
    silver, snapshot = lake.silver_transactions(), lake.silver_accounts()
    rejected, rejected_accounts = lake.rejected_transactions(), lake.rejected_accounts()
    daily, weekly, log = lake.gold_daily(), lake.gold_weekly(), lake.run_log()
    tables = {
        "silver_transaction_codes": codes,
        "silver_accounts": snapshot,
        "silver_transactions": silver,
        "gold_daily_summary": daily,
        "gold_weekly_account_summary": weekly,
    }
    reconciliation = RC.reconcile(transactions, silver, rejected)
    both = rejected.select("_rejection_reason").unionByName(rejected_accounts.select("_rejection_reason"))
    source_codes = EX.scan_static(lake.spark, f"{lake.source}/transaction_codes.csv", S.CODE_SOURCE)
    results = [
        CK.b01(_extract_rows(lake, "transactions", last), transactions),
        CK.b02(_extract_rows(lake, "accounts", last), accounts),
        CK.b03(source_codes, bronze_codes),
        CK.b04(transactions, accounts, bronze_codes),
        CK.b05(transactions),
        CK.st01(silver),
        CK.silver_row_checks(silver),
        CK.st04(reconciliation),
        CK.st05(both),
        CK.st06(silver, CK.amounts_alike(rejected), S.TRANSACTION_SOURCE.names),
        CK.st07(silver, log),
        CK.st08(silver, codes),
        CK.st09(reconciliation),
        CK.sa01(snapshot),
        CK.account_row_checks(snapshot),
        CK.account_reject_checks(rejected_accounts),
        CK.g01(silver, daily),
        CK.daily_totals_checks(silver, daily),
        CK.g04(silver, codes, weekly),
        CK.weekly_row_checks(weekly),
        CK.g07(daily, weekly),
        CK.at01(lake.control(), last),
        CK.at02(transactions, accounts, bronze_codes, log),
        CK.at03(daily, weekly, log),
        CK.or01(silver.select("date").distinct(), RL.accounts_ready(log)),
        CK.indicator_values(codes),
        CK.declared_tests(tables),
        *[CK.expect_rows(f"EXISTS-{name}", table) for name, table in tables.items()],
        CK.expect_rows("EXISTS-bronze_transactions", transactions),
        CK.expect_rows("EXISTS-bronze_accounts", accounts),
        CK.expect_rows("EXISTS-run_log", log),
        CK.result("FILES-run_log", lake.log_journal().broken()),
    ]
    if earlier_metrics is not None:
        results.append(CK.i01(RC.compare_metrics(earlier_metrics, lake_metrics(lake))))
    return CK.combine(results)
