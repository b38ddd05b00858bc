from __future__ import annotations

import glob
import os
import shutil
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerstrata import schemas as S
from ledgerstrata.operators import runlog as RL
from ledgerstrata.operators.reconcile import compare_metrics
from ledgerstrata.plans import jobs
from ledgerstrata.plans.lake import Lake
from ledgerstrata.plans.verify import lake_checks, lake_metrics
from ledgerstrata.sources.tables import keep, shared_dir
from tests import sample
from tests.sample import D1, D2, D3

D7 = date(2024, 7, 7)
# Expected daily figures of the seven-day sample, by hand, as
# (signed, online, in store, purchases, their sum, sums of payments, fees and interest).
DAILY = [
    ("-234.45", 1, 2, 1, "18.40", "-260.00", "7.15", "0"),
    ("110.90", 2, 1, 2, "105.85", "0", "0", "5.05"),
    ("-234.50", 2, 1, 2, "76.25", "-310.75", "0", "0"),
    ("164.69", 2, 1, 2, "154.70", "0", "9.99", "0"),
    ("-316.85", 2, 1, 1, "76.80", "-405.10", "0", "11.45"),
    ("-122.45", 0, 3, 1, "62.70", "-189.00", "0", "3.85"),
    ("-88.60", 1, 2, 2, "62.00", "-150.60", "0", "0"),
]
# Expected weekly figures, as (purchases, mean, payments, fees, interest, balance).
WEEKLY = {
    "L-1": (4, "60.413", "-721.35", "0", "5.05", "85.17"),
    "L-2": (4, "49.675", "-405.10", "7.15", "3.85", "1701.55"),
    "L-3": (3, "38.783", "-189.00", "9.99", "11.45", "448.79"),
}


def new_lake(spark, folder, days=7) -> Lake:
    sample.write_week(f"{folder}/source", days)
    return Lake(spark, f"{folder}/lake", f"{folder}/source")


def statuses(lake: Lake, model: str) -> dict:
    log = RL.latest_attempts(lake.run_log()).where(F.col("model_name") == model)
    return {r["processing_date"]: r["status"] for r in log.collect()}


def violations(checked) -> dict:
    return {r["check_id"]: r["violations"] for r in checked.collect()}


@pytest.fixture(scope="module")
def week(spark, tmp_path_factory) -> Lake:
    """Six days by a historical run, the seventh by an incremental one."""
    lake = new_lake(spark, tmp_path_factory.mktemp("week"))
    assert jobs.run_historical(lake, D1, date(2024, 7, 6), "run-a") == date(2024, 7, 6)
    assert jobs.run_incremental(lake, "run-b") == D7
    return lake


def test_golden_layers(week):
    assert week.bronze("transactions").count() == 35
    assert week.bronze("accounts").count() == 20
    assert week.silver_codes().count() == 4
    silver = week.silver_transactions()
    assert (silver.count(), silver.where("NOT _is_resolvable").count()) == (28, 7)
    reasons = [r["_rejection_reason"] for r in week.quarantine().collect()]
    assert sorted(reasons) == [S.INVALID_AMOUNT] * 3 + [S.INVALID_CHANNEL] * 2 + [S.INVALID_TRANSACTION_CODE] * 2
    assert week.silver_accounts().count() == 3
    assert RL.read_watermark(week.spark, week.control_path) == D7


def test_golden_daily(week):
    rows = week.gold_daily().orderBy("transaction_date").collect()
    found = []
    for row in rows:
        kinds = row["transactions_by_type"]
        assert row["total_transactions"] == 3
        found.append(
            (row["total_signed_amount"], row["online_transactions"], row["instore_transactions"],
             kinds["PURCHASE"]["count"], kinds["PURCHASE"]["sum"], *(kinds[k]["sum"] for k in ("PAYMENT", "FEE", "INTEREST")))
        )
    assert found == [tuple(Decimal(x) if isinstance(x, str) else x for x in day) for day in DAILY]
    assert {(r["_source_period_start"], r["_source_period_end"]) for r in rows} == {(D1, D7)}


def test_golden_weekly(week):
    found = {
        r["account_id"]: (r["total_purchases"], str(r["avg_purchase_amount"]), r["total_payments"], r["total_fees"],
                          r["total_interest"], r["closing_balance"])
        for r in week.gold_weekly().collect()
    }
    expected = {k: (n, mean, *map(Decimal, rest)) for k, (n, mean, *rest) in WEEKLY.items()}
    assert found == expected


def test_log_rows(week):
    log = week.run_log()
    assert {r["pipeline_type"] for r in log.select("pipeline_type").distinct().collect()} == {
        "HISTORICAL", "INCREMENTAL"}
    row = log.where((F.col("model_name") == "silver_transactions") & (F.col("processing_date") == D2)).first()
    assert (row["records_processed"], row["records_written"], row["records_rejected"]) == (5, 4, 1)
    assert set(statuses(week, "silver_transactions").values()) == {"SUCCESS"}


def test_no_next_extract_is_a_clean_no_op(week):
    before = week.run_log().count()
    assert jobs.run_incremental(week, "run-c") is None
    assert week.run_log().count() == before
    assert RL.read_watermark(week.spark, week.control_path) == D7


def test_checks_pass_and_a_repeat_changes_nothing(week):
    stored = keep(lake_metrics(week), shared_dir(week.spark, "metrics"))
    assert stored.count() == 10
    assert jobs.run_historical(week, D1, D7, "run-d") == D7
    assert compare_metrics(stored, lake_metrics(week)).isEmpty()
    found = violations(lake_checks(week, D7, stored))
    assert len(found) == 30 + 3 + 16 + 9 and not any(found.values()), found
    # the repeat loaded nothing again
    loads = week.run_log().where("run_id = 'run-d' AND layer = 'BRONZE'")
    assert {r["status"] for r in loads.collect()} == {"SKIPPED"}


def test_incremental_needs_a_historical_run(spark, tmp_path):
    with pytest.raises(RuntimeError):
        jobs.run_incremental(new_lake(spark, tmp_path, 1), "run-a")


def test_missing_extracts(spark, tmp_path):
    lake = new_lake(spark, tmp_path, 4)
    os.remove(f"{lake.source}/transactions_{D3}.csv")
    os.remove(f"{lake.source}/accounts_{D2}.csv")
    # transactions of day two go on without deltas; day three holds the mark
    assert jobs.run_historical(lake, D1, date(2024, 7, 4), "run-a") == D2
    found = statuses(lake, "silver_transactions")
    assert found == {D1: "SUCCESS", D2: "SUCCESS", D3: "SKIPPED", date(2024, 7, 4): "SUCCESS"}
    assert statuses(lake, "bronze_accounts")[D2] == "SKIPPED"
    # account 3 is unknown until its first delta arrives on day three
    flags = {r["date"]: r["_is_resolvable"]
             for r in lake.silver_transactions().where("account_id = 'L-3'").collect()}
    assert flags == {D2: False, date(2024, 7, 4): True}
    # the late extract closes the gap; what was published stays as it is
    sample.write_transactions(lake.source, D3, sample.week_rows(D3))
    assert jobs.run_incremental(lake, "run-b") == date(2024, 7, 4)
    assert lake.silver_transactions().count() == 16


def test_bad_rows_late_rows_and_duplicates(spark, tmp_path):
    lake = new_lake(spark, tmp_path, 2)
    sample.write_transactions(
        lake.source,
        D2,
        [
            "T-1-1,L-1,2024-07-02,1.00,PURCH01,,ONLINE",  # accepted on day one
            "T-1-5,L-1,2024-07-02,1.00,PURCH01,,ONLINE",  # rejected on day one
            "N-1,L-1,2024-07-01,4.00,PURCH01,,ONLINE",  # late: belongs to day one in Gold
            "N-2,L-1,2024-07-02,abc,PURCH01,,ONLINE",
            "N-3,L-1,yesterday,1.00,PURCH01,,ONLINE",
            "N-4,L-1,2024-07-02,1.00,WRONG,,ONLINE",
            "N-5,L-1,2024-07-02,1.00,PURCH01,,ONLINE",
            "N-5,L-1,2024-07-02,1.00,PURCH01,,ONLINE",
        ],
    )
    sample.write_accounts(lake.source, D2, ["L-9,n,FROZEN,1,1,2020-01-01,2024-07-01,2024-07-31"])
    assert jobs.run_historical(lake, D1, D1, "run-a") == D1
    assert jobs.run_incremental(lake, "run-b") == D2
    rejects = lake.rejected_transactions().where(F.col("date") == D2).collect()
    found = sorted((r["transaction_id"], r["_rejection_reason"]) for r in rejects)
    assert found == [
        ("N-2", S.INVALID_AMOUNT), ("N-3", S.NULL_REQUIRED_FIELD), ("N-4", S.INVALID_TRANSACTION_CODE),
        ("N-5", S.DUPLICATE_TRANSACTION_ID), ("T-1-1", S.DUPLICATE_TRANSACTION_ID),
    ]
    raw = {r["transaction_id"]: (r["amount"], r["transaction_date"]) for r in rejects}
    assert raw["N-2"][0] == "abc" and raw["N-3"][1] == "yesterday"
    assert lake.quarantine().where("entity = 'accounts'").count() == 1
    totals = {r["transaction_date"]: r["total_signed_amount"] for r in lake.gold_daily().collect()}
    assert totals == {D1: Decimal("-230.450"), D2: Decimal("2.000")}
    assert not any(violations(lake_checks(lake, D2)).values())


def test_a_failed_batch_publishes_nothing_and_recovers(spark, tmp_path, monkeypatch):
    lake = new_lake(spark, tmp_path, 2)
    assert jobs.run_historical(lake, D1, D1, "run-a") == D1
    gold = lake.gold_daily().collect()

    real = jobs.reconcile

    def broken(*tables):
        raise RuntimeError("lost /data/x after the write")

    monkeypatch.setattr(jobs, "reconcile", broken)
    assert jobs.run_historical(lake, D1, D2, "run-b") is None
    assert statuses(lake, "silver_transactions") == {D1: "SUCCESS", D2: "FAILED"}
    failure = lake.run_log().where("status = 'FAILED'").first()
    assert failure["error_message"] == "lost <path> after the write"
    # day two is on disk but not published, Gold and watermark did not move
    assert lake.silver_transactions().where(F.col("date") == D2).count() == 4
    assert lake.published_transactions().where(F.col("date") == D2).count() == 0
    assert lake.gold_daily().collect() == gold
    assert RL.read_watermark(spark, lake.control_path) == D1

    monkeypatch.setattr(jobs, "reconcile", real)
    assert jobs.run_incremental(lake, "run-c") == D2
    # its own leftovers did not count as duplicates
    assert lake.quarantine().count() == 2
    assert not any(violations(lake_checks(lake, D2)).values())


def test_broken_bronze_is_rewritten(spark, tmp_path):
    lake = new_lake(spark, tmp_path, 2)
    run = jobs.Run(lake, "run-a", S.HISTORICAL)
    jobs.load_bronze(run, "transactions", [D1, D2])
    part = glob.glob(f"{lake.root}/bronze/transactions/date={D1}/*.parquet")[0]
    with open(part, "wb") as out:
        out.write(b"no parquet")
    crc = os.path.join(os.path.dirname(part), f".{os.path.basename(part)}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    again = jobs.load_bronze(jobs.Run(lake, "run-b", S.HISTORICAL), "transactions", [D1, D2])
    assert [(o.day, o.status) for o in again] == [(D1, "SUCCESS"), (D2, "SKIPPED")]
    assert lake.bronze("transactions").count() == 10
    # a source that grew since is a mismatch too
    sample.write_transactions(lake.source, D2, sample.week_rows(D2)[:3])
    again = jobs.load_bronze(jobs.Run(lake, "run-c", S.HISTORICAL), "transactions", [D1, D2])
    assert [(o.day, o.status, o.written) for o in again] == [(D1, "SKIPPED", 0), (D2, "SUCCESS", 3)]


def test_the_guard_stops_stale_accounts(spark, tmp_path, monkeypatch):
    lake = new_lake(spark, tmp_path, 1)
    monkeypatch.setattr(jobs, "build_accounts", lambda run, days: [])
    assert jobs.run_historical(lake, D1, D1, "run-a") is None
    row = lake.run_log().where("model_name = 'silver_transactions'").first()
    assert row["status"] == "FAILED" and "accounts not current" in row["error_message"]
    assert RL.read_watermark(spark, lake.control_path) is None


def test_a_day_as_a_folder_of_parts(spark, tmp_path):
    lake = new_lake(spark, tmp_path, 1)
    whole = f"{lake.source}/transactions_{D1}.csv"
    os.remove(whole)
    header, rows = ",".join(S.TRANSACTION_SOURCE.names), sample.week_rows(D1)
    sample.write(f"{whole}/part-0.csv", [header, *rows[:2]])
    sample.write(f"{whole}/part-1.csv", [header, *rows[2:]])
    assert jobs.run_historical(lake, D1, D1, "run-a") == D1
    assert {r["_source_file"] for r in lake.bronze("transactions").collect()} == {f"transactions_{D1}.csv"}
    assert lake.silver_transactions().count() == 4


def test_copy_of_a_lake_moves(spark, week, tmp_path):
    """Tables carry no absolute paths: a copied lake reads the same."""
    shutil.copytree(week.root, tmp_path / "copy")
    moved = Lake(spark, str(tmp_path / "copy"), week.source)
    assert moved.silver_transactions().count() == week.silver_transactions().count()
    assert moved.gold_daily().count() == 7


def test_calendar_gaps_do_not_matter_for_order(spark, tmp_path):
    """Loading day two before day one flags the same rows as loading in order."""
    lake = new_lake(spark, tmp_path, 2)
    rows = ["S-1,L-1,2024-07-01,1.00,PURCH01,,ONLINE"]
    sample.write_transactions(lake.source, D1, rows)
    sample.write_transactions(lake.source, D2, rows)
    jobs.run_historical(lake, D2, D2, "run-a")
    jobs.run_historical(lake, D1, D1, "run-b")
    # the id was taken when day one came in, whatever its date
    found = {(r["date"], r["_rejection_reason"]) for r in lake.quarantine().collect()}
    assert found == {(D1, S.DUPLICATE_TRANSACTION_ID)}
    assert lake.silver_transactions().count() == 1
    assert RL.read_watermark(spark, lake.control_path) == D1 + timedelta(days=1)


def flags(lake: Lake) -> dict:
    rows = lake.silver_transactions().select("date", "transaction_id", "_is_resolvable")
    return {tuple(r)[:2]: r["_is_resolvable"] for r in rows.collect()}


def test_deltas_of_a_broken_run_do_not_count_before_their_day(spark, tmp_path, monkeypatch):
    """Bronze of days 1 to 4 lands and the run breaks; day three must not know day four's account."""
    def source(folder):
        lake = new_lake(spark, folder, 4)
        day4 = D1 + timedelta(days=3)
        new = "L-4,Holder 4,ACTIVE,2500.00,10.00,2021-09-30,2024-07-01,2024-07-31"
        sample.write_accounts(lake.source, day4, [*sample.account_rows(day4), new])
        sample.write_transactions(lake.source, D3, [*sample.week_rows(D3), "N-1,L-4,2024-07-03,5.00,PURCH01,,ONLINE"])
        return lake

    clean = source(tmp_path / "clean")
    assert jobs.run_historical(clean, D1, D3, "run-a") == D3
    broken = source(tmp_path / "broken")
    real = jobs.build_accounts

    def fails(run, days):
        raise RuntimeError("lost")

    monkeypatch.setattr(jobs, "build_accounts", fails)
    assert jobs.run_historical(broken, D1, D1 + timedelta(days=3), "run-a") is None
    monkeypatch.setattr(jobs, "build_accounts", real)
    assert jobs.run_historical(broken, D1, D2, "run-b") == D2
    assert jobs.run_incremental(broken, "run-c") == D3
    assert flags(broken) == flags(clean) and not flags(broken)[(D3, "N-1")]
    assert {r["account_id"] for r in broken.silver_accounts().collect()} == {"L-1", "L-2", "L-3"}


def test_a_broken_extract_costs_its_own_day(spark, tmp_path):
    lake = new_lake(spark, tmp_path, 4)
    sample.write(f"{lake.source}/transactions_{D3}.csv", ["wrong,header", "1,2"])
    assert jobs.run_historical(lake, D1, D1 + timedelta(days=3), "run-a") == D2
    found = statuses(lake, "bronze_transactions")
    assert found == {D1: "SUCCESS", D2: "SUCCESS", D3: "FAILED", D1 + timedelta(days=3): "SUCCESS"}
    assert lake.gold_daily().count() == 3
    sample.write_transactions(lake.source, D3, sample.week_rows(D3))
    assert jobs.run_incremental(lake, "run-b") == D1 + timedelta(days=3)
    assert lake.gold_daily().count() == 4


@pytest.mark.parametrize("table", ["accounts", "transaction_codes"])
def test_a_missing_state_table_is_an_error(spark, tmp_path, table):
    lake = new_lake(spark, tmp_path, 2)
    assert jobs.run_historical(lake, D1, D1, "run-a") == D1
    shutil.rmtree(f"{lake.root}/silver/{table}")
    assert jobs.run_incremental(lake, "run-b") is None
    failure = lake.run_log().where("status = 'FAILED'").first()
    assert "is missing although" in failure["error_message"]
    assert RL.read_watermark(spark, lake.control_path) == D1


def test_a_rewritten_day_without_rows_keeps_none(spark, tmp_path):
    lake = new_lake(spark, tmp_path, 2)
    jobs.load_bronze(jobs.Run(lake, "run-a", S.HISTORICAL), "transactions", [D1, D2])
    sample.write_transactions(lake.source, D2, [])
    jobs.load_bronze(jobs.Run(lake, "run-b", S.HISTORICAL), "transactions", [D1, D2])
    assert {r["date"] for r in lake.bronze("transactions").collect()} == {D1}


def test_bare_years_are_no_dates(spark, tmp_path):
    lake = new_lake(spark, tmp_path, 1)
    days = ["2024", "2024-7", "2024-07-01T99", "2024-07-01"]
    rows = [f"Y-{n},L-1,{day},1.00,PURCH01,,ONLINE" for n, day in enumerate(days)]
    sample.write_transactions(lake.source, D1, rows)
    assert jobs.run_historical(lake, D1, D1, "run-a") == D1
    assert [r["transaction_id"] for r in lake.silver_transactions().collect()] == ["Y-3"]
    assert {r["_rejection_reason"] for r in lake.quarantine().collect()} == {S.NULL_REQUIRED_FIELD}
