"""Every check must notice the defect it is there for."""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerstrata import schemas as S
from ledgerstrata.operators import checks as CK
from ledgerstrata.operators import reconcile as RC
from ledgerstrata.operators import runlog as RL
from ledgerstrata.plans import jobs
from ledgerstrata.plans.lake import Lake
from ledgerstrata.plans.verify import lake_checks
from tests import sample
from tests.sample import D1, D2


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory) -> Lake:
    folder = tmp_path_factory.mktemp("checks")
    sample.write_week(f"{folder}/source", 2)
    sample.write_accounts(f"{folder}/source", D2, ["L-9,n,FROZEN,1,1,2020-01-01,2024-07-01,2024-07-31"])
    made = Lake(spark, f"{folder}/lake", f"{folder}/source")
    assert jobs.run_historical(made, D1, D2, "run-a") == D2
    return made


def doubled(rows):
    return rows.unionAll(rows.limit(1))


def first_without(rows, column):
    """The same rows with NULL in one of them."""
    key = rows.select(F.min(rows.columns[0])).first()[0]
    hit = F.col(rows.columns[0]) == F.lit(key)
    return rows.withColumn(column, F.when(~hit, F.col(column)))


def wrong(rows, column, value):
    return rows.withColumn(column, F.lit(value).cast(rows.schema[column].dataType))


def codes_of(lake):
    return lake.silver_codes()


DEFECTS = {
    "B-01": lambda k: CK.b01(doubled(k.bronze("transactions")), k.bronze("transactions")),
    "B-01 missing date": lambda k: CK.b01(
        k.bronze("transactions"), k.bronze("transactions").where(F.col("date") == D1)
    ),
    "B-02": lambda k: CK.b02(doubled(k.bronze("accounts")), k.bronze("accounts")),
    "B-03": lambda k: CK.b03(doubled(codes_of(k)), codes_of(k)),
    "B-03 empty": lambda k: CK.b03(codes_of(k), codes_of(k).limit(0)),
    "B-04": lambda k: CK.b04(k.bronze("transactions"), first_without(k.bronze("accounts"), "_pipeline_run_id")),
    "B-05": lambda k: CK.b05(wrong(k.bronze("transactions"), "amount", "-1.00")),
    "ST-01": lambda k: CK.st01(doubled(k.silver_transactions())),
    "ST-02": lambda k: CK.silver_row_checks(first_without(k.silver_transactions(), "_signed_amount"), "ST-02"),
    "ST-03": lambda k: CK.silver_row_checks(first_without(k.silver_transactions(), "_is_resolvable"), "ST-03"),
    "ST-04": lambda k: CK.st04(
        RC.reconcile(k.bronze("transactions"), doubled(k.silver_transactions()), k.rejected_transactions())
    ),
    "ST-05": lambda k: CK.st05(first_without(k.rejected_transactions(), "_rejection_reason")),
    "ST-05 unknown": lambda k: CK.st05(wrong(k.rejected_transactions(), "_rejection_reason", "OTHER")),
    "ST-06": lambda k: CK.st06(
        k.silver_transactions(),
        k.silver_transactions().withColumn("_rejection_reason", F.lit(S.INVALID_CHANNEL)),
        ["transaction_id", "account_id", "merchant_name"],
    ),
    "ST-07": lambda k: CK.st07(wrong(k.silver_transactions(), "_pipeline_run_id", "nobody"), k.run_log()),
    "ST-07 null": lambda k: CK.st07(first_without(k.silver_transactions(), "_pipeline_run_id"), k.run_log()),
    "ST-08": lambda k: CK.st08(k.silver_transactions(), codes_of(k).where("transaction_code <> 'PAY01'")),
    "ST-09": lambda k: CK.st09(
        RC.reconcile(k.bronze("transactions"), k.silver_transactions(), k.rejected_transactions().limit(0))
    ),
    "SA-01": lambda k: CK.sa01(doubled(k.silver_accounts())),
    "SA-02": lambda k: CK.account_row_checks(first_without(k.silver_accounts(), "_pipeline_run_id"), "SA-02"),
    "SA-03": lambda k: CK.account_row_checks(first_without(k.silver_accounts(), "_record_valid_from"), "SA-03"),
    "SA-04": lambda k: CK.account_row_checks(wrong(k.silver_accounts(), "account_status", "FROZEN"), "SA-04"),
    "SA-05": lambda k: CK.account_reject_checks(
        first_without(k.rejected_accounts(), "_rejection_reason"), "SA-05"
    ),
    "SA-06": lambda k: CK.account_reject_checks(
        wrong(k.rejected_accounts(), "_rejection_reason", S.INVALID_CHANNEL), "SA-06"
    ),
    "G-01": lambda k: CK.g01(k.silver_transactions(), k.gold_daily().limit(1)),
    "G-01 extra": lambda k: CK.g01(k.silver_transactions().where(F.col("date") == D1), k.gold_daily()),
    "G-02": lambda k: CK.daily_totals_checks(
        k.silver_transactions(), wrong(k.gold_daily(), "total_transactions", 9), "G-02"
    ),
    "G-03": lambda k: CK.daily_totals_checks(
        k.silver_transactions(), k.gold_daily().withColumn(
            "total_signed_amount", F.col("total_signed_amount") + F.lit(0.01).cast("decimal(18,3)")), "G-03"
    ),
    "G-04": lambda k: CK.g04(k.silver_transactions(), codes_of(k), wrong(k.gold_weekly(), "total_purchases", 9)),
    "G-05": lambda k: CK.weekly_row_checks(wrong(k.gold_weekly(), "week_start_date", "2024-07-02"), "G-05"),
    "G-06": lambda k: CK.weekly_row_checks(wrong(k.gold_weekly(), "week_end_date", "2024-07-08"), "G-06"),
    "G-07": lambda k: CK.g07(k.gold_daily(), first_without(k.gold_weekly(), "_pipeline_run_id")),
    "AT-01": lambda k: CK.at01(k.control(), date(2024, 7, 3)),
    "AT-01 none": lambda k: CK.at01(k.control().limit(0), D2),
    "AT-01 twice": lambda k: CK.at01(doubled(k.control()), D2),
    "AT-02": lambda k: CK.at02(
        k.bronze("transactions"), k.bronze("accounts"), k.bronze_codes(),
        k.run_log().where("model_name <> 'bronze_accounts'"),
    ),
    "AT-03": lambda k: CK.at03(
        k.gold_daily(), k.gold_weekly(), k.run_log().where("model_name <> 'gold_weekly_account_summary'")
    ),
    "OR-01": lambda k: CK.or01(
        k.silver_transactions().select("date").distinct(),
        RL.accounts_ready(k.run_log().where("model_name <> 'silver_accounts'")),
    ),
    "TC-01": lambda k: CK.indicator_values(wrong(codes_of(k), "debit_credit_indicator", "XX")),
}


@pytest.mark.parametrize("name", DEFECTS)
def test_a_defect_is_noticed(lake, name):
    row = DEFECTS[name](lake).collect()
    assert len(row) == 1
    assert row[0]["check_id"] == name.split()[0] and row[0]["violations"] > 0


def test_declared_tests_notice_nulls_and_repeats(lake):
    tables = {
        "silver_transaction_codes": doubled(codes_of(lake)),
        "silver_accounts": first_without(doubled(lake.silver_accounts()), "_pipeline_run_id"),
        "silver_transactions": first_without(lake.silver_transactions(), "_is_resolvable"),
        "gold_daily_summary": doubled(lake.gold_daily()),
        "gold_weekly_account_summary": first_without(lake.gold_weekly(), "account_id"),
    }
    found = {r["check_id"]: r["violations"] for r in CK.declared_tests(tables).collect()}
    assert len(found) == 16
    assert {name for name, n in found.items() if n} == {
        "DT-silver_transaction_codes-transaction_code-unique",
        "DT-silver_accounts-account_id-unique",
        "DT-silver_accounts-_pipeline_run_id-not_null",
        "DT-silver_transactions-_is_resolvable-not_null",
        "DT-gold_daily_summary-transaction_date-unique",
        "DT-gold_weekly_account_summary-account_id-not_null",
    }


def test_a_sound_lake_has_no_violation_and_an_absent_one_does(spark, lake, tmp_path):
    found = {r["check_id"]: r["violations"] for r in lake_checks(lake, D2).collect()}
    assert not any(found.values()), found
    nothing = Lake(spark, str(tmp_path / "none"), lake.source)
    found = {r["check_id"]: r["violations"] for r in lake_checks(nothing, D2).collect()}
    failed = {name for name, n in found.items() if n}
    assert {"B-01", "B-02", "B-03", "AT-01", "EXISTS-gold_daily_summary", "EXISTS-run_log"} <= failed


def test_row_checks_share_one_scan(lake):
    plan = CK.account_row_checks(lake.silver_accounts())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_a_later_watermark_is_no_pass(lake):
    row = CK.at01(lake.control(), D2 - timedelta(days=1)).first()
    assert row["violations"] == 1
