"""Journals, manifests, damage to written tables, and days that change after they were published."""

from __future__ import annotations

import glob
import os
import shutil
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerstrata import schemas as S
from ledgerstrata.operators import manifest as MF
from ledgerstrata.operators import runlog as RL
from ledgerstrata.plans import jobs
from ledgerstrata.plans.lake import Lake
from ledgerstrata.plans.verify import lake_checks
from ledgerstrata.sources import tables as TB
from ledgerstrata.sources.buckets import BucketedIds
from ledgerstrata.sources.journal import Journal
from tests import sample
from tests.sample import D1, D2, D3

NOON = datetime(2024, 7, 1, 12, tzinfo=timezone.utc)


def entry(spark, n: int, when: datetime = NOON):
    row = ("t", D1 + timedelta(days=n), None, n, Decimal(n), None, None, "run", when + timedelta(seconds=n))
    return TB.small_table(spark, [row], S.MANIFEST)


def numbers(journal: Journal) -> list[int]:
    return sorted(r["rows"] for r in journal.rows().collect())


def files(path: str) -> list[str]:
    return glob.glob(f"{path}/entries/month=*/*.parquet")


# ---------------------------------------------------------------------------
# Journals
# ---------------------------------------------------------------------------
def test_a_journal_is_folded_and_stays_the_same(spark, tmp_path):
    path = str(tmp_path / "log")
    journal = Journal(spark, path, S.MANIFEST, "recorded_at")
    assert journal.rows().count() == 0 and journal.compact() == [] and journal.broken().count() == 0
    for n in range(4):
        journal.append(entry(spark, n))
    assert journal.compact(most=4) == []
    assert journal.compact(most=3) == ["2024-07"]
    assert numbers(journal) == [0, 1, 2, 3] and len(files(path)) == 4
    journal.append(entry(spark, 4))
    journal.append(entry(spark, 5, NOON + timedelta(days=40)))
    assert numbers(journal) == [0, 1, 2, 3, 4, 5]
    assert journal.compact(most=0) == ["2024-07", "2024-08"]
    # what the first fold took in is gone, what the second took in is still there
    assert numbers(journal) == [0, 1, 2, 3, 4, 5] and len(files(path)) == 2
    assert journal.compact(most=0) == []


def test_a_fold_that_breaks_loses_and_doubles_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    journal = Journal(spark, path, S.MANIFEST, "recorded_at")
    for n in range(3):
        journal.append(entry(spark, n))
    half = f"{path}/compacted/month=2024-07/version-0000000001"
    entry(spark, 9).write.parquet(half)
    os.remove(f"{half}/_SUCCESS")  # a fold that did not end
    assert numbers(journal) == [0, 1, 2]
    assert journal.compact(most=1) == ["2024-07"]
    assert numbers(journal) == [0, 1, 2]


def test_broken_files_are_named_and_left_out(spark, tmp_path):
    path = str(tmp_path / "log")
    journal = Journal(spark, path, S.MANIFEST, "recorded_at")
    for n in range(3):
        journal.append(entry(spark, n))
    TB.write_junk(spark, f"{path}/entries/month=2024-07/part-junk.parquet")
    TB.write_junk(spark, f"{path}/stray.txt")
    for _ in range(2):
        assert numbers(journal) == [0, 1, 2]
        names = {r["file"] for r in journal.broken().collect()}
        assert names == {"part-junk.parquet", "stray.txt"}
        journal.compact(most=1)


def test_the_log_stays_small_over_many_runs(spark, tmp_path):
    path = str(tmp_path / "log")
    for n in range(12):
        row = (f"run-{n}", "HISTORICAL", "m", "SILVER", D1, NOON, NOON, "SUCCESS", n, None, None, None)
        RL.append_run_log(TB.small_table(spark, [row], S.RUN_LOG), path)
        RL.journal(spark, path).compact(most=2)
        assert len(files(path)) <= 6
    assert [r["records_processed"] for r in RL.read_run_log(spark, path).collect()].sort() is None
    assert RL.read_run_log(spark, path).count() == 12


# ---------------------------------------------------------------------------
# Fingerprints
# ---------------------------------------------------------------------------
def test_fingerprints_see_content_and_not_order(spark):
    rows = [("a", None), (None, "a"), ("b", "c"), ("b", "c")]

    def of(values):
        frame = spark.createDataFrame([(D1, *v) for v in values], "date date, x string, y string")
        (row,) = MF.by_date(frame.repartition(3), ["x", "y"]).collect()
        return row["rows"], row["fingerprint"]

    assert of(rows) == of(rows[::-1])
    for other in (rows[:3], [*rows[:3], ("b", "d")], [("a", None), ("a", None), *rows[2:]]):
        assert of(other) != of(rows)


def test_manifests_tell_two_runs_apart(spark):
    def manifest(amount):
        rows = spark.createDataFrame([(D1, "1", "5"), (D2, "2", amount)], "date date, id string, amount string")
        counted = MF.by_date(rows, ["id", "amount"]).collect()
        return TB.small_table(spark, MF.entries(counted, "silver_transactions", [D1, D2, D3], "run", NOON), S.MANIFEST)

    assert MF.compare(manifest("7"), manifest("7")).isEmpty()
    assert [tuple(r) for r in MF.compare(manifest("7"), manifest("8")).collect()] == [("silver_transactions", D2, 1, 1)]
    assert {(r["date"], r["rows"]) for r in manifest("7").collect()} == {(D1, 1), (D2, 1), (D3, 0)}


# ---------------------------------------------------------------------------
# Damage to Bronze
# ---------------------------------------------------------------------------
def test_damaged_days_are_found_and_loaded_again(spark, tmp_path):
    sample.write_week(f"{tmp_path}/source", 5)
    lake = Lake(spark, f"{tmp_path}/lake", f"{tmp_path}/source")
    days = [D1 + timedelta(days=n) for n in range(5)]
    jobs.load_bronze(jobs.Run(lake, "run-a", S.HISTORICAL), "transactions", days)
    before = sorted(map(str, lake.bronze("transactions").drop("_ingested_at", "_pipeline_run_id").collect()))
    folder = f"{lake.root}/bronze/transactions"
    TB.drop_files(spark, f"{folder}/date={days[0]}")
    TB.cut_files(spark, f"{folder}/date={days[1]}")
    TB.spoil_files(spark, f"{folder}/date={days[2]}")
    extra = glob.glob(f"{folder}/date={days[4]}/*.parquet")[0]
    shutil.copy(extra, f"{folder}/date={days[3]}/part-stray.parquet")
    found = {r["date"]: (r["bronze_rows"], r["sound"]) for r in jobs.bronze_rows_found(lake, "transactions", days).collect()}
    assert found == {day: (5, True) if day == days[4] else (None, False) for day in days}
    # a stray file is not the load's, and a dynamic overwrite of the day takes it away
    again = jobs.load_bronze(jobs.Run(lake, "run-b", S.HISTORICAL), "transactions", days)
    assert [o.status for o in again] == ["SUCCESS"] * 4 + ["SKIPPED"]
    assert sorted(map(str, lake.bronze("transactions").drop("_ingested_at", "_pipeline_run_id").collect())) == before
    assert jobs.bronze_rows_found(lake, "transactions", days).where("NOT sound").isEmpty()


def test_other_faults_are_not_taken_for_broken_extracts(spark, tmp_path, monkeypatch):
    sample.write_week(f"{tmp_path}/source", 4)
    lake = Lake(spark, f"{tmp_path}/lake", f"{tmp_path}/source")
    calls = []

    def full(run, entity, days):
        calls.append(days)
        raise RuntimeError("no space left on device")

    monkeypatch.setattr(jobs, "load_bronze", full)
    with pytest.raises(RuntimeError):
        jobs.load_isolated(jobs.Run(lake, "run-a", S.HISTORICAL), "transactions", [D1, D2, D3])
    assert len(calls) == 1


# ---------------------------------------------------------------------------
# Days that change after they were published
# ---------------------------------------------------------------------------
def report(lake: Lake) -> tuple:
    daily = {r["transaction_date"]: (r["total_transactions"], r["total_signed_amount"]) for r in lake.gold_daily().collect()}
    return daily, lake.silver_transactions().count(), lake.rejected_transactions().count()


@pytest.fixture
def published(spark, tmp_path) -> Lake:
    sample.write_week(f"{tmp_path}/source", 3)
    lake = Lake(spark, f"{tmp_path}/lake", f"{tmp_path}/source", id_buckets=3)
    assert jobs.run_historical(lake, D1, D3, "run-a") == D3
    return lake


def test_a_day_that_grows_is_judged_again(published):
    lake = published
    before, silver, rejected = report(lake)
    more = ["N-1,L-1,2024-07-02,4.00,PURCH01,,ONLINE", "T-1-1,L-1,2024-07-02,9.00,PURCH01,,ONLINE",
            "T-3-1,L-1,2024-07-02,9.00,PURCH01,,ONLINE"]
    sample.write_transactions(lake.source, D2, [*sample.week_rows(D2), *more])
    stamps = lake.silver_accounts().select("account_id", "_pipeline_run_id", "_record_valid_from").collect()
    assert jobs.run_historical(lake, D1, D3, "run-b") == D3
    after, silver_after, rejected_after = report(lake)
    # one row more goes in; the ids of the days before and after are taken
    assert (silver_after, rejected_after) == (silver + 1, rejected + 2)
    assert after == before | {D2: (before[D2][0] + 1, before[D2][1] + 4)}
    judged = lake.run_log().where("run_id = 'run-b' AND model_name = 'silver_transactions'")
    assert [r["processing_date"] for r in judged.collect()] == [D2]
    # accounts have no new delta, so their rows are as they were
    assert sorted(stamps) == sorted(lake.silver_accounts().select("account_id", "_pipeline_run_id", "_record_valid_from").collect())
    assert not any(r["violations"] for r in lake_checks(lake, D3).collect())
    # nothing has changed since: nothing is judged
    assert jobs.run_historical(lake, D1, D3, "run-c") == D3
    assert lake.run_log().where("run_id = 'run-c' AND model_name = 'silver_transactions'").isEmpty()


def test_gold_leaves_out_a_day_that_moved_and_was_not_judged(published, monkeypatch):
    lake = published
    sample.write_transactions(lake.source, D2, [*sample.week_rows(D2), "N-1,L-1,2024-07-02,4.00,PURCH01,,ONLINE"])
    jobs.load_bronze(jobs.Run(lake, "run-b", S.HISTORICAL), "transactions", [D2])  # and the run breaks
    assert {r["date"] for r in lake.promotion_gate().collect()} == {D1, D3}
    assert {r["date"] for r in lake.published_transactions().select("date").distinct().collect()} == {D1, D3}
    assert jobs.moved_days(lake, [D1, D2, D3]) == {D2}
    assert jobs.run_historical(lake, D2, D2, "run-c") == D3
    assert {r["date"] for r in lake.promotion_gate().collect()} == {D1, D2, D3}
    assert lake.gold_daily().count() == 3


def test_the_gate_needs_every_bronze_row(published):
    lake = published
    run = jobs.Run(lake, "run-b", S.HISTORICAL)
    bronze = MF.versions(lake.manifest(), "bronze_transactions").collect()
    short = MF.versions(lake.manifest(), "silver_quarantine").select("date", (F.col("rows") - 1).alias("rows"), "fingerprint")
    run.record(MF.entries(short.collect(), "silver_quarantine", [D2], run.run_id, run.now, bronze))
    assert {r["date"] for r in lake.promotion_gate().collect()} == {D1, D3}


def test_a_broken_repeat_leaves_no_ids(published, monkeypatch):
    """Ids a judgement stored before it broke are of no judgement."""
    lake = published
    sample.write_transactions(lake.source, D2, [*sample.week_rows(D2), "N-1,L-1,2024-07-02,4.00,PURCH01,,ONLINE"])
    real = Journal.append

    def broken(self, rows):
        if "silver_quarantine" in {r["table_name"] for r in rows.select("table_name").distinct().collect()}:
            raise RuntimeError("lost")
        return real(self, rows)

    run = jobs.Run(lake, "run-b", S.HISTORICAL)
    jobs.load_bronze(run, "transactions", [D2])
    with monkeypatch.context() as m:
        m.setattr(Journal, "append", lambda self, rows: broken(self, rows) if "table_name" in rows.columns else real(self, rows))
        with pytest.raises(RuntimeError):
            jobs.build_transactions(run, [D2])
    assert jobs.run_historical(lake, D1, D3, "run-c") == D3
    assert lake.silver_transactions().where("transaction_id = 'N-1'").count() == 1


def test_lost_ids_are_filled_from_silver(published):
    lake = published
    shutil.rmtree(f"{lake.root}/silver/transaction_ids")
    day4 = D1 + timedelta(days=3)
    sample.write_accounts(lake.source, day4, sample.account_rows(day4))
    sample.write_transactions(lake.source, day4, [*sample.week_rows(day4), "T-1-1,L-1,2024-07-04,9.00,PURCH01,,ONLINE"])
    assert jobs.run_incremental(lake, "run-b") == day4
    rejected = lake.rejected_transactions().where("transaction_id = 'T-1-1'").collect()
    assert [r["_rejection_reason"] for r in rejected] == [S.DUPLICATE_TRANSACTION_ID]


def test_ids_are_folded_without_those_out_of_force(spark, tmp_path):
    table = BucketedIds(spark, str(tmp_path / "ids"), 2)
    assert not table.exists() and table.rows().count() == 0
    for n in range(4):
        when = F.lit(NOON + timedelta(minutes=n)).cast("timestamp")
        table.append(spark.range(10 * n, 10 * n + 10).select(
            F.col("id").cast("string").alias("transaction_id"), F.lit(D1).alias("date"), when.alias("judged_at")))
    held = table.rows().select("date", "judged_at").distinct().where(F.col("judged_at") > F.lit(NOON).cast("timestamp"))
    assert table.rows().count() == 40 and table.valid(held).count() == 30
    kept = spark.createDataFrame(held.collect(), held.schema)
    assert not table.compact(lambda: kept, most=10)
    assert table.compact(lambda: kept, most=2)
    assert table.rows().count() == 30
    # another session describes the table to itself
    assert BucketedIds(spark.newSession(), str(tmp_path / "ids"), 2).rows().count() == 30


def test_junk_in_the_log_folder_does_not_stop_a_run(published, caplog):
    lake = published
    TB.write_junk(lake.spark, f"{lake.log_path}/junk.parquet")
    month = os.path.basename(glob.glob(f"{lake.log_path}/entries/month=*")[0])
    TB.write_junk(lake.spark, f"{lake.log_path}/entries/{month}/part-junk.parquet")
    day4 = D1 + timedelta(days=3)
    sample.write_accounts(lake.source, day4, sample.account_rows(day4))
    sample.write_transactions(lake.source, day4, sample.week_rows(day4))
    assert jobs.run_incremental(lake, "run-b") == date(2024, 7, 4)
    assert {r.args[0] for r in caplog.records if "left out" in r.msg} == {"junk.parquet", "part-junk.parquet"}
    found = {r["check_id"]: r["violations"] for r in lake_checks(lake, day4).collect()}
    assert found.pop("FILES-run_log") == 2 and not any(found.values())
