"""What the physical plans must look like for the operators to scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from ledgerstrata import schemas as S
from ledgerstrata.functions.scalars import is_iso_day
from ledgerstrata.operators import checks as CK
from ledgerstrata.operators import gold as GD
from ledgerstrata.operators import manifest as MF
from ledgerstrata.operators.accounts import newest_per_account
from ledgerstrata.operators.transactions import classify_transactions
from ledgerstrata.plans import jobs
from ledgerstrata.plans.lake import Lake, on_dates
from ledgerstrata.sources.tables import Scratch
from tests import sample
from tests.sample import D1, D2


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def scans(plan: str, table: str) -> list[str]:
    return [line for line in plan.split("\n") if "FileScan" in line and f"/{table}" in line]


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory) -> Lake:
    folder = tmp_path_factory.mktemp("plans")
    sample.write_week(f"{folder}/source", 2)
    made = Lake(spark, f"{folder}/lake", f"{folder}/source")
    jobs.run_historical(made, D1, D2, "run-a")
    return made


def classified(lake, keep, before=None):
    return classify_transactions(
        on_dates(lake.addressed_transactions(), [D2]),
        lake.silver_codes(),
        keep(jobs.known_accounts(lake, [D2])),
        before,
        keep=keep,
    )


def test_the_batch_is_not_shuffled(spark, lake):
    with Scratch(spark, "plan") as scratch:
        plan = plan_of(classified(lake, scratch.keep, on_dates(lake.silver_transactions(), [D1])))
    assert plan.count("BroadcastHashJoin") == 3 and "SortMergeJoin" not in plan
    exchanges = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
    assert set(exchanges) <= {"transaction_code"}  # the code table only
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Window" not in plan


def test_large_sides_are_joined_without_broadcast(spark, lake):
    """Past the size limit the joins sort, and AQE may split hot keys."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with Scratch(spark, "plan") as scratch:
            frame = classified(lake, scratch.keep, on_dates(lake.silver_transactions(), [D1]))
            plan = plan_of(frame)
            assert frame.count() == 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert plan.count("SortMergeJoin") == 3 and "Broadcast" not in plan


def test_history_ids_can_be_filtered_ahead_of_their_shuffle(spark, lake):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1",
    }
    before = {name: spark.conf.get(name) for name in settings}
    plans = []

    def watch(scratch):
        def keep(rows):
            plans.append(plan_of(rows))
            return scratch.keep(rows)

        return keep

    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        with Scratch(spark, "plan") as scratch:
            classified(lake, watch(scratch), on_dates(lake.silver_transactions(), [D1]))
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert any("might_contain" in plan for plan in plans)


def test_bucketed_history_is_not_shuffled(spark, lake, tmp_path):
    """A day whose ids are too many for a broadcast meets the history bucket by bucket."""
    from datetime import datetime

    from ledgerstrata.sources.buckets import BucketedIds

    table, when = BucketedIds(spark, str(tmp_path / "ids"), 8), datetime(2024, 7, 2)
    ids = spark.range(400_000).select(F.sha2(F.col("id").cast("string"), 256).alias("transaction_id"))
    stamped = ids.withColumns({"date": F.lit(D1), "judged_at": F.lit(when)})
    table.append(stamped.where("transaction_id < '8'"))
    table.append(stamped.where("transaction_id >= '8'"))
    in_force = stamped.limit(1).select("date", "judged_at")
    assert table.valid(in_force).count() == 400_000
    day = ids.withColumns({"date": F.lit(D2), "_copies": F.lit(1)})
    with Scratch(spark, "plan") as scratch:
        plans = []

        def keep(rows):
            plans.append(plan_of(rows))
            return scratch.keep(rows)

        columns = {"account_id": F.lit("L-1"), "transaction_date": F.lit(str(D2)), "amount": F.lit("1"),
                   "transaction_code": F.lit("PURCH01"), "merchant_name": F.lit(None).cast("string"),
                   "channel": F.lit("ONLINE"), "_row_id": F.col("transaction_id")}
        frame = classify_transactions(
            scratch.keep(day.drop("_copies").withColumns(columns)), lake.silver_codes(),
            keep(jobs.known_accounts(lake, [D2])), table.valid(in_force), keep=keep,
        )
        assert frame.where("_rejection_reason = 'DUPLICATE_TRANSACTION_ID'").count() == 400_000
    (plan,) = [p for p in plans if "Bucketed: true" in p]
    join = plan[plan.index("SortMergeJoin") :] if "SortMergeJoin" in plan else plan[plan.index("ShuffledHashJoin") :]
    history = next(i for i, line in enumerate(join.split("\n")) if "Bucketed: true" in line)
    above = join.split("\n")[:history]
    # between the join and the bucketed scan there is no exchange of its rows
    depth = join.split("\n")[history].index("FileScan")
    chain = []
    for line in reversed(above):
        at = len(line) - len(line.lstrip(" :+-*()0123456789"))
        if at < depth:
            chain.append(line)
            depth = at
    assert not any("Exchange hashpartitioning" in line for line in chain if "Join" not in line), plan


def test_a_day_of_gold_reads_a_day_of_silver(spark, lake, monkeypatch):
    plans = []
    real = jobs.replace_partitions

    def watch(rows, path, *columns):
        plans.append((path, plan_of(rows)))
        return real(rows, path, *columns)

    monkeypatch.setattr(jobs, "replace_partitions", watch)
    run = jobs.Run(lake, "run-z", S.HISTORICAL)
    again = MF.by_date(on_dates(lake.silver_transactions(), [D2]), ["transaction_id"]).collect()
    bronze = MF.versions(lake.manifest(), "bronze_transactions").collect()
    run.record(MF.entries(again, "silver_transactions", [D2], "run-z", run.now, bronze))
    jobs.refresh_partials(run, [D1, D2])
    written = [plan for path, plan in plans if "partials" in path]
    assert len(written) == 2
    for plan in written:
        (line,) = scans(plan, "lake/silver/transactions")
        assert str(D2) in line.split("PartitionFilters")[1] or "19906" in line.split("PartitionFilters")[1]
        assert str(D1) not in line.split("PartitionFilters")[1]
    for table in (lake.gold_daily(), lake.gold_weekly()):
        assert table.count()


def test_gold_does_not_read_silver_rows(lake, monkeypatch):
    plans = []
    monkeypatch.setattr(jobs, "replace_table", lambda rows, path: plans.append(plan_of(rows)))
    run = jobs.Run(lake, "run-z", S.HISTORICAL)
    for model in ("gold_daily_summary", "gold_weekly_account_summary"):
        jobs.build_gold(run, model, [D1, D2])
    assert len(plans) == 2
    for plan in plans:
        assert "partials" in plan and not scans(plan, "lake/silver/transactions")


def test_history_is_read_by_id_and_date_only(spark, lake):
    plans = []
    with Scratch(spark, "plan") as scratch:

        def keep(rows):
            plans.append(plan_of(rows))
            return scratch.keep(rows)

        classified(lake, keep, on_dates(lake.silver_transactions(), [D1]))
    history = [line for plan in plans for line in scans(plan, "lake/silver/transactions")]
    assert history
    for line in history:
        assert "ReadSchema: struct<transaction_id:string>" in line
        assert "PartitionFilters: [isnotnull(date" in line or "date#" in line.split("PartitionFilters")[1]


def test_daily_gold_reads_silver_once_and_narrow(lake):
    plan = plan_of(GD.daily_totals(lake.silver_transactions(), lake.silver_codes()))
    lines = scans(plan, "lake/silver/transactions")
    assert len(lines) == 1
    read = lines[0].split("ReadSchema: ")[1]
    for absent in ("merchant_name", "_source_file", "account_id", "_promoted_at"):
        assert absent not in read
    # rows are folded before the code lookup
    assert plan.index("transaction_type") < plan.index("FileScan")
    assert "partial_sum" in plan


def test_weekly_gold_pushes_the_flag_down(lake):
    plan = plan_of(GD.weekly_totals(lake.silver_transactions(), lake.silver_codes()))
    (line,) = scans(plan, "lake/silver/transactions")
    assert "EqualTo(_is_resolvable,true)" in line or "_is_resolvable" in line.split("PushedFilters")[1]
    assert "partial_sum" in plan


def test_published_dates_prune_partitions(lake):
    plan = plan_of(GD.daily_totals(lake.published_transactions(), lake.silver_codes()))
    (line,) = scans(plan, "lake/silver/transactions")
    assert "dynamicpruning" in line.lower()


def test_reference_checks_fold_before_a_shuffled_join(spark, lake):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(CK.st08(lake.silver_transactions(), lake.silver_codes()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    join = plan.index("LeftAnti")
    assert "partial_count" in plan[join:]  # the fold lies below the join


def test_newest_rows_are_found_by_hash_and_without_whole_groups(lake):
    plan = plan_of(newest_per_account(lake.bronze("accounts")))
    assert "partial_max(date" in plan and "SortAggregate" not in plan
    assert re.search(r"WindowGroupLimit .*Partial", plan)


def test_bronze_counts_read_no_column(lake):
    from ledgerstrata.operators.bronze import rows_per_date

    (line,) = scans(plan_of(rows_per_date(lake.bronze("transactions"), "n")), "lake/bronze")
    assert "ReadSchema: struct<>" in line


def test_a_one_day_read_touches_one_partition(lake):
    frame = on_dates(lake.silver_transactions(), [D2])
    assert {r["date"] for r in frame.select("date").distinct().collect()} == {D2}
    (line,) = scans(plan_of(frame), "lake/silver")
    assert "PartitionFilters: [(date" in line or "PartitionFilters: [isnotnull(date" in line


def test_schema_of_written_tables(lake):
    stored = lake.spark.read.parquet(lake.outcome_path(S.ACCEPTED))
    types = {f.name: f.dataType for f in stored.schema}
    for field in S.SILVER_TRANSACTIONS:
        assert types[field.name] == field.dataType
    assert lake.silver_transactions().where(F.col("_signed_amount").isNull()).isEmpty()


def test_large_rulings_meet_the_batch_by_hash(spark, tmp_path):
    """Rulings too large for a broadcast: the batch is shuffled by id, but not sorted, while their parts are small."""
    rows = spark.range(4000).selectExpr("CAST(id % 3000 AS STRING) AS transaction_id", "id AS n")
    rulings = spark.range(3000).selectExpr("CAST(id AS STRING) AS transaction_id", "id AS ruling")
    parts = []
    for name, frame in (("rows", rows), ("rulings", rulings)):
        frame.write.parquet(f"{tmp_path}/{name}")
        parts.append(spark.read.parquet(f"{tmp_path}/{name}"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = parts[0].join(parts[1], "transaction_id", "left")
        assert len(joined.collect()) == 4000
        plan = joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("text", ["2024-01-1 ", "2024-01-1T", " 2024-01-1", "+2024-01-0", "2024-1-002", "2024-02-30"])
def test_ten_characters_are_no_day_by_themselves(spark, text):
    found = spark.createDataFrame([(text,), ("2024-01-02",)], "t string").select(is_iso_day(F.col("t"))).collect()
    assert [r[0] for r in found] == [False, True]
