from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest

from ledgerstrata import schemas as S
from ledgerstrata.operators import accounts as AC
from ledgerstrata.operators import gold as GD
from ledgerstrata.operators.codes import silver_transaction_codes
from ledgerstrata.operators.quarantine import quarantine_accounts, quarantine_all, rejection_summary
from ledgerstrata.sources.tables import small_table
from tests import sample
from tests.sample import D1, D2, NOW, RUN_ID

SUNDAY, NEXT_MONDAY = date(2024, 7, 7), date(2024, 7, 8)


def deltas(spark, rows):
    """Bronze deltas from (date, id, status, limit, balance[, opened])."""
    full = [
        (r[1], "name", r[2], r[3], r[4], r[5] if len(r) > 5 else "2020-01-01", "2024-07-01", "2024-07-31",
         f"accounts_{r[0]}.csv", NOW, RUN_ID, r[0])
        for r in rows
    ]
    return small_table(spark, full, S.BRONZE_ACCOUNTS)


def test_account_rules(spark):
    rows = [
        (D1, "1", "ACTIVE", "1", "1"),
        (D1, "2", "FROZEN", "1", "1"),
        (D1, "3", "ACTIVE", None, "1"),
        (D1, " ", "ACTIVE", "1", "1"),
        (D1, "5", "FROZEN", None, "1"),
        (D1, "6", "CLOSED", "1", "x"),
        (D1, "7", "SUSPENDED", "1", "1"),
        (D1, "8", "ACTIVE", "1", "1", "not a date"),
        (D1, "9", None, "1", "1"),
    ]
    classified = AC.classify_accounts(deltas(spark, rows))
    found = {r["account_id"]: r["_rejection_reason"] for r in classified.collect()}
    null = S.NULL_REQUIRED_FIELD
    assert found == {
        "1": None, "2": S.INVALID_ACCOUNT_STATUS, "3": null, " ": null, "5": null,
        "6": null, "7": None, "8": null, "9": null,
    }
    rejects = quarantine_accounts(classified, RUN_ID, NOW)
    assert rejects.count() == 7
    summary = {(r["_rejection_reason"], r["rejected_rows"]) for r in rejection_summary(rejects).collect()}
    assert summary == {(null, 6), (S.INVALID_ACCOUNT_STATUS, 1)}


def test_newest_delta_wins(spark):
    rows = [
        (D1, "1", "ACTIVE", "1", "10"),
        (D2, "1", "CLOSED", "1", "20"),
        (D2, "2", "FROZEN", "1", "99"),  # rejected, so the older one stays
        (D1, "2", "ACTIVE", "1", "30"),
        (D1, "3", "ACTIVE", "1", "41"),  # twice on one date: one row, always the same
        (D1, "3", "ACTIVE", "1", "40"),
    ]
    passing = AC.passing_accounts(AC.classify_accounts(deltas(spark, rows)))
    table = AC.silver_accounts(passing, RUN_ID, NOW)
    assert [f.name for f in table.schema] == S.SILVER_ACCOUNTS.names
    found = {r["account_id"]: (r["account_status"], r["current_balance"]) for r in table.collect()}
    assert found == {"1": ("CLOSED", 20), "2": ("ACTIVE", 30), "3": ("ACTIVE", 41)}
    first = {r["account_id"]: r["known_from"] for r in AC.first_sightings(passing).collect()}
    assert first == {"1": D1, "2": D1, "3": D1}


def test_upsert_equals_rebuild(spark):
    rows = [(D1, "1", "ACTIVE", "1", "10"), (D1, "2", "ACTIVE", "1", "20"), (D2, "1", "CLOSED", "1", "11"),
            (D2, "3", "ACTIVE", "1", "30")]
    passing = AC.passing_accounts(AC.classify_accounts(deltas(spark, rows)))
    early = AC.newest_per_account(passing.where("date = DATE '2024-07-01'"))
    late = AC.newest_per_account(passing.where("date = DATE '2024-07-02'"))
    merged = AC.upsert_accounts(early, late)
    assert sorted(merged.collect()) == sorted(AC.newest_per_account(passing).select(merged.columns).collect())


def silver(spark, rows):
    """Silver rows from (own date, account, signed, code, channel, resolvable)."""
    full = [
        (str(n), r[1], r[0], abs(Decimal(r[2])), r[3], None, r[4], "f", NOW, r[5], Decimal(r[2]), RUN_ID, NOW, D1)
        for n, r in enumerate(rows)
    ]
    return small_table(spark, full, S.SILVER_TRANSACTIONS)


def snapshot(spark, **balances):
    row = ("name", "ACTIVE", Decimal("1.00"))
    tail = (D1, D1, D1, "f", NOW, RUN_ID, NOW)
    rows = [(k, *row, Decimal(v), *tail) for k, v in balances.items()]
    return small_table(spark, rows, S.SILVER_ACCOUNTS)


def test_daily_summary(spark):
    rows = [
        (D1, "A", "10.00", "PURCH01", "ONLINE", True),
        (D1, "A", "-4.00", "PAY01", "IN_STORE", True),
        (D1, "X", "99.00", "PURCH01", "ONLINE", False),
        (D2, "X", "99.00", "PURCH01", "ONLINE", False),  # nothing resolvable: a zero row
        (SUNDAY, "A", "1.00", "OTHER", "ONLINE", True),  # counted, in no type
    ]
    table = GD.gold_daily_summary(silver(spark, rows), sample.codes(spark), RUN_ID, NOW)
    assert table.schema.names == S.GOLD_DAILY.names
    assert [f.dataType.simpleString() for f in table.schema] == [
        f.dataType.simpleString() for f in S.GOLD_DAILY
    ]
    found = {r["transaction_date"]: r.asDict(recursive=True) for r in table.collect()}
    assert len(found) == 3
    one = found[D1]
    assert (one["total_transactions"], one["total_signed_amount"]) == (2, Decimal("6.000"))
    assert (one["online_transactions"], one["instore_transactions"]) == (1, 1)
    zero = {"count": 0, "sum": Decimal("0.000")}
    assert one["transactions_by_type"] == {
        "PURCHASE": {"count": 1, "sum": Decimal("10.000")},
        "PAYMENT": {"count": 1, "sum": Decimal("-4.000")},
        "FEE": zero,
        "INTEREST": zero,
    }
    assert found[D2]["total_transactions"] == 0
    assert found[D2]["total_signed_amount"] == Decimal("0.000")
    assert found[D2]["transactions_by_type"]["PURCHASE"] == zero
    assert found[SUNDAY]["total_transactions"] == 1
    assert all(c == zero for c in found[SUNDAY]["transactions_by_type"].values())
    assert {(r["_source_period_start"], r["_source_period_end"]) for r in found.values()} == {(D1, SUNDAY)}


def test_weekly_summary(spark):
    rows = [
        (D1, "A", "10.00", "PURCH01", "ONLINE", True),
        (SUNDAY, "A", "11.00", "PURCH01", "ONLINE", True),  # same ISO week
        (NEXT_MONDAY, "A", "-3.00", "PAY01", "ONLINE", True),  # payments only
        (D1, "B", "5.00", "FEE01", "ONLINE", True),  # not in the snapshot
        (D1, "X", "5.00", "PURCH01", "ONLINE", False),
    ]
    table = GD.gold_weekly_account_summary(
        silver(spark, rows), sample.codes(spark), snapshot(spark, A="42.50"), RUN_ID, NOW
    )
    assert table.schema.names == S.GOLD_WEEKLY.names
    found = {(r["week_start_date"], r["account_id"]): r for r in table.collect()}
    assert set(found) == {(D1, "A"), (NEXT_MONDAY, "A"), (D1, "B")}
    first = found[(D1, "A")]
    assert (first["week_end_date"], first["total_purchases"]) == (SUNDAY, 2)
    assert (first["avg_purchase_amount"], first["closing_balance"]) == (Decimal("10.500"), Decimal("42.500"))
    second = found[(NEXT_MONDAY, "A")]
    assert (second["total_purchases"], second["avg_purchase_amount"]) == (0, None)
    assert (second["total_payments"], second["total_fees"]) == (Decimal("-3.000"), Decimal("0.000"))
    assert found[(D1, "B")]["closing_balance"] is None
    assert found[(D1, "B")]["total_fees"] == Decimal("5.000")


@pytest.mark.parametrize("amounts, mean", [(("10.00", "10.01"), "10.005"), (("0.01",) * 2 + ("0.02",), "0.013")])
def test_the_mean_is_exact(spark, amounts, mean):
    rows = [(D1, "A", a, "PURCH01", "ONLINE", True) for a in amounts]
    weekly = GD.weekly_totals(silver(spark, rows), sample.codes(spark))
    assert weekly.first()["avg_purchase_amount"] == Decimal(mean)


def test_codes_carry_over(spark):
    bronze = small_table(
        spark, [("C", "d", "DR", "FEE", "true", "transaction_codes.csv", NOW, "old")], S.BRONZE_CODES
    )
    table = silver_transaction_codes(bronze, RUN_ID)
    assert sorted(table.columns) == sorted(S.SILVER_CODES.names)
    row = table.first()
    assert (row["affects_balance"], row["_pipeline_run_id"]) == (True, RUN_ID)


def test_union_of_rejects_by_name(spark):
    txn = small_table(
        spark, [("1", "A", "d", "1", "C", None, "ONLINE", "f", RUN_ID, NOW, "R", D1)], S.QUARANTINE_TRANSACTIONS
    )
    acc = small_table(
        spark, [("A", "n", "S", "1", "1", "d", "d", "d", "f", RUN_ID, NOW, "R", D1)], S.QUARANTINE_ACCOUNTS
    )
    rows = {r["entity"]: r for r in quarantine_all(txn, acc).collect()}
    assert rows["accounts"]["transaction_id"] is None and rows["transactions"]["customer_name"] is None
