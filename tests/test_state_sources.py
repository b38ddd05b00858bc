from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from ledgerstrata import schemas as S
from ledgerstrata.functions.scalars import scrub_error
from ledgerstrata.operators import bronze as BR
from ledgerstrata.operators import quarantine as QU
from ledgerstrata.operators import reconcile as RC
from ledgerstrata.operators import runlog as RL
from ledgerstrata.sources import extracts as EX
from ledgerstrata.sources import tables as TB
from tests import sample
from tests.sample import D1, D2, D3, NOW

BASE = datetime(2024, 2, 1, tzinfo=timezone.utc)


def attempts(spark, rows):
    """Log rows from (model, date, minute, status)."""
    full = [
        (f"run-{minute}", "HISTORICAL", model, "SILVER", day, BASE + timedelta(minutes=minute),
         BASE + timedelta(minutes=minute, seconds=1), status, None, None, None, None)
        for model, day, minute, status in rows
    ]
    return TB.small_table(spark, full, S.RUN_LOG)


def test_append_and_read_in_order(spark, tmp_path):
    path = str(tmp_path / "log")
    assert RL.read_run_log(spark, path).count() == 0
    RL.append_run_log(attempts(spark, [("m", D1, 5, "SUCCESS")]), path)
    RL.append_run_log(attempts(spark, [("m", D1, 2, "FAILED")]), path)
    assert [r["run_id"] for r in RL.read_run_log(spark, path).collect()] == ["run-2", "run-5"]


@pytest.mark.parametrize("field", S.RUN_LOG_REQUIRED)
def test_required_log_fields(spark, tmp_path, field):
    rows = attempts(spark, [("m", D1, 1, "SUCCESS")])
    broken = rows.withColumn(field, F.lit(None).cast(rows.schema[field].dataType))
    with pytest.raises(ValueError, match=field):
        RL.append_run_log(broken, str(tmp_path / "log"))
    assert not TB.table_exists(spark, str(tmp_path / "log"))


def test_the_latest_attempt_decides(spark):
    log = attempts(spark, [("m", D1, 1, "SUCCESS"), ("m", D1, 2, "FAILED"), ("m", D2, 3, "SUCCESS")])
    found = {r["processing_date"]: r["status"] for r in RL.latest_attempts(log).collect()}
    assert found == {D1: "FAILED", D2: "SUCCESS"}
    assert [r["date"] for r in RL.succeeded_dates(log, "m").collect()] == [D2]


def test_accounts_ready(spark):
    log = attempts(
        spark,
        [
            ("bronze_accounts", D1, 1, "SUCCESS"),
            ("silver_accounts", D1, 2, "SUCCESS"),
            ("bronze_accounts", D2, 9, "SKIPPED"),
            ("silver_accounts", D2, 3, "SUCCESS"),  # older than Bronze
            ("bronze_accounts", D3, 1, "SUCCESS"),
            ("silver_accounts", D3, 2, "FAILED"),
        ],
    )
    found = {r["processing_date"]: r["accounts_ready"] for r in RL.accounts_ready(log).collect()}
    assert found == {D1: True, D2: False, D3: False}


def full_day(day, minute, status="SUCCESS"):
    return [(m, day, minute + i, status) for i, m in enumerate(RL.WATERMARK_MODELS)]


@pytest.mark.parametrize(
    "rows, expected",
    [
        (full_day(D1, 0) + full_day(D2, 10), D2),
        (full_day(D1, 0) + full_day(D3, 10), D1),  # a day nobody logged
        (full_day(D1, 0) + full_day(D2, 10, "FAILED") + full_day(D3, 20), D1),
        (full_day(D1, 0) + full_day(D2, 10, "FAILED") + full_day(D2, 20), D2),  # retried
        (full_day(D1, 0, "FAILED") + full_day(D2, 10), None),
        (full_day(D1, 0)[:2] + full_day(D2, 10), None),  # weekly Gold missing
        ([], None),
    ],
)
def test_watermark_stops_before_the_first_gap(spark, rows, expected):
    row = RL.watermark_from_log(attempts(spark, rows)).first()
    assert (row["last_processed_date"] if row else None) == expected


def test_control_table(spark, tmp_path):
    path = str(tmp_path / "control")
    assert RL.read_watermark(spark, path) is None
    with pytest.raises(RuntimeError):
        RL.require_next_date(spark, path)
    for bad in ("2024-1-1", "01.01.2024", "2024-02-30", ""):
        with pytest.raises(ValueError):
            RL.write_watermark(spark, path, bad, "run", NOW)
    RL.write_watermark(spark, path, "2024-07-31", "run", NOW)
    RL.write_watermark(spark, path, D1, "run", NOW)  # overwrites
    assert RL.read_watermark(spark, path) == D1
    assert RL.require_next_date(spark, path) == D2
    TB.append_rows(TB.small_table(spark, [(D2, NOW, "run")], S.CONTROL), TB.current_path(spark, path))
    with pytest.raises(ValueError):
        RL.read_watermark(spark, path)


def test_error_text_is_scrubbed(spark):
    texts = ["cannot open /a/b.c now", r"bad C:\data\x.csv here", "x" * 900]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [r[0] for r in frame.select(scrub_error(F.col("t"))).collect()]
    assert found == ["cannot open <path> now", "bad <path> here", "x" * 500]


def test_scan_of_dated_extracts(spark, tmp_path):
    folder = str(tmp_path)
    sample.write_week(folder, days=2)
    rows = EX.scan_entity(spark, folder, "transactions", S.TRANSACTION_SOURCE)
    counts = {(r["date"], r["_source_file"]): r["source_rows"] for r in EX.source_counts(rows).collect()}
    assert counts == {
        (D1, "transactions_2024-07-01.csv"): 5,
        (D2, "transactions_2024-07-02.csv"): 5,
    }
    row = rows.where("transaction_id = 'T-1-1'").first()
    assert (row["amount"], row["merchant_name"]) == ("18.40", None)  # text kept, empty is NULL
    files = EX.list_extracts(spark, folder, "accounts")
    assert {r["date"] for r in files.collect()} == {D1, D2}
    absent = EX.missing_dates(EX.calendar(spark, D1, date(2024, 7, 4)), files)
    assert {r["date"] for r in absent.collect()} == {D3, date(2024, 7, 4)}
    assert EX.list_extracts(spark, folder, "nothing").count() == 0


def test_moved_columns_fail(spark, tmp_path):
    header = ",".join(reversed(S.TRANSACTION_SOURCE.names))
    sample.write(f"{tmp_path}/transactions_2024-07-01.csv", [header, "1,2,3,4,5,6,7"])
    with pytest.raises(Exception, match="header"):
        EX.scan_entity(spark, str(tmp_path), "transactions", S.TRANSACTION_SOURCE).collect()


def test_load_plan(spark):
    def counts(name, **days):
        rows = [(date(2024, 7, int(d[1:])), n) for d, n in days.items()]
        return spark.createDataFrame(rows, f"date date, {name} bigint")

    plan = BR.load_plan(counts("source_rows", d1=5, d2=5, d3=5), counts("bronze_rows", d1=5, d2=4, d9=1))
    found = {r["date"].day: r["action"] for r in plan.collect()}
    assert found == {1: "SKIP", 2: "REWRITE", 3: "WRITE", 9: "SKIP"}


def test_partitions_are_replaced_alone(spark, tmp_path):
    path = str(tmp_path / "t")

    def rows(*pairs):
        return spark.createDataFrame(pairs, "v int, date date")

    TB.replace_partitions(rows((1, D1), (2, D2)), path)
    TB.replace_partitions(rows((3, D2)), path)
    found = {(r["v"], r["date"]) for r in spark.read.parquet(path).collect()}
    assert found == {(1, D1), (3, D2)}
    TB.drop_partitions(spark, path, [D2, D3])
    one = TB.scan_partition(spark, path, rows((1, D1)).schema, D1)
    assert [r["v"] for r in one.collect()] == [1]
    assert "PartitionFilters: [isnotnull(date" in one._jdf.queryExecution().toString()


def test_a_table_can_be_rebuilt_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    TB.replace_table(spark.range(3), path)
    schema = spark.range(1).schema
    TB.replace_table(TB.scan_table(spark, path, schema).union(spark.range(10, 11)), path)
    assert {r["id"] for r in TB.scan_table(spark, path, schema).collect()} == {0, 1, 2, 10}
    TB.replace_table(spark.range(7), path)
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == ["version-0000000002", "version-0000000003"]


def test_a_write_that_breaks_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = spark.range(1).schema
    assert not TB.table_exists(spark, path)
    TB.replace_table(spark.range(3), path)
    with pytest.raises(Exception):
        TB.replace_table(spark.range(5).selectExpr("assert_true(id < 3) as x", "id"), path)
    # a version without its marker is no table, and the next write clears it
    (tmp_path / "t" / "version-0000000009").mkdir()
    assert TB.scan_table(spark, path, schema).count() == 3
    TB.replace_table(spark.range(4), path)
    assert TB.scan_table(spark, path, schema).count() == 4
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == ["version-0000000001", "version-0000000010"]
    # only broken versions: the table is absent
    (tmp_path / "u" / "version-0000000001").mkdir(parents=True)
    assert not TB.table_exists(spark, str(tmp_path / "u"))
    assert TB.scan_table(spark, str(tmp_path / "u"), schema).count() == 0


def test_absent_tables_are_empty_and_typed(spark, tmp_path):
    rows = TB.scan_table(spark, str(tmp_path / "none"), S.GOLD_DAILY)
    assert rows.schema.names == S.GOLD_DAILY.names and rows.count() == 0


def test_scratch_tables_are_removed(spark, tmp_path):
    with TB.Scratch(spark, "probe") as scratch:
        assert scratch.keep(spark.range(5)).count() == 5
        assert TB.table_exists(spark, scratch._root)
    assert not TB.table_exists(spark, scratch._root)


def test_reconciliation_and_gate(spark):
    def rows(*days):
        return spark.createDataFrame([(d,) for d in days], "date date")

    checked = RC.reconcile(rows(D1, D1, D2, D2), rows(D1, D2), rows(D1, D3))
    found = {r["date"]: r["delta"] for r in checked.collect()}
    assert found == {D1: 0, D2: 1, D3: -1}
    assert [r["date"] for r in RC.promotion_gate(checked).collect()] == [D1]
    assert RC.reconcile_total(checked).first()["delta"] == 0


def test_metric_comparison(spark):
    def metrics(**values):
        return spark.createDataFrame(list(values.items()), "metric string, value int")

    assert RC.compare_metrics(metrics(a=1, b=None), metrics(a=1, b=None)).isEmpty()
    differing = RC.compare_metrics(metrics(a=1, b=2, c=3), metrics(a=1, b=3, d=4))
    assert {r["metric"] for r in differing.collect()} == {"b", "c", "d"}


def test_quotes_line_breaks_and_ragged_rows(spark, tmp_path):
    folder, header = str(tmp_path), ",".join(S.TRANSACTION_SOURCE.names)
    good = '1,L-1,2024-07-01,2.00,PURCH01,"Joe ""The"" Shop, Inc",ONLINE'
    sample.write(f"{folder}/transactions_2024-07-01.csv", [header, good])
    row = EX.scan_entity(spark, folder, "transactions", S.TRANSACTION_SOURCE).first()
    assert (row["merchant_name"], row["channel"]) == ('Joe "The" Shop, Inc', "ONLINE")
    for bad in ("1,2,3,4", good + ",more"):
        sample.write(f"{folder}/transactions_2024-07-01.csv", [header, bad])
        with pytest.raises(Exception):
            EX.scan_entity(spark, folder, "transactions", S.TRANSACTION_SOURCE).collect()
    broken = good.replace("Shop, Inc", "Shop\nInc")
    sample.write(f"{folder}/transactions_2024-07-01.csv", [header, broken])
    path = f"{folder}/transactions_2024-07-01.csv"
    with pytest.raises(Exception):
        EX.scan_extracts(spark, [path], S.TRANSACTION_SOURCE).collect()
    rows = EX.scan_extracts(spark, [path], S.TRANSACTION_SOURCE, multi_line=True).collect()
    assert [r["merchant_name"] for r in rows] == ['Joe "The" Shop\nInc']


def test_only_exact_names_are_extracts(spark, tmp_path):
    folder, header = str(tmp_path), ",".join(S.TRANSACTION_SOURCE.names)
    names = ["transactions_2024-07-01", "old_transactions_2024-07-01", "transactions_2024-07-01_old", "transactions_x"]
    for name in names:
        sample.write(f"{folder}/{name}.csv", [header, "1,L-1,2024-07-01,2.00,PURCH01,,ONLINE"])
    assert EX.scan_entity(spark, folder, "transactions", S.TRANSACTION_SOURCE).count() == 1
    for days in (None, [D1, D2], [D1 + timedelta(days=i) for i in range(90)]):
        assert EX.list_extracts(spark, folder, "transactions", days).count() == 1
    assert EX.list_extracts(spark, folder, "transactions", []).count() == 0


def test_quarantine_has_one_schema(spark):
    kinds = [(None, None), (spark.createDataFrame([], S.QUARANTINE_TRANSACTIONS), None),
             (None, spark.createDataFrame([], S.QUARANTINE_ACCOUNTS))]
    assert len({str(QU.quarantine_all(*k).schema.names) for k in kinds}) == 1
