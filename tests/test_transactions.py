from __future__ import annotations

import random
from datetime import timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerstrata import schemas as S
from ledgerstrata.operators.transactions import (
    classify_transactions,
    promote_transactions,
    split_by_disposition,
)
from tests import sample
from tests.sample import D1, D2, D3


def good(day, ident, amount="10.00", account="A", code="PURCH01", channel="ONLINE"):
    return (day, ident, account, amount, code, channel)


def reasons(spark, rows, **options):
    """Rejection reason per input row, in input order."""
    classified = classify_transactions(
        sample.bronze(spark, rows), sample.codes(spark), sample.known(spark, A=D1), **options
    )
    found = {row["_row_id"]: row["_rejection_reason"] for row in classified.collect()}
    assert len(found) == len(rows)
    return [found[n] for n in range(len(rows))]


NULL, AMOUNT, DUPLICATE = S.NULL_REQUIRED_FIELD, S.INVALID_AMOUNT, S.DUPLICATE_TRANSACTION_ID
CODE, CHANNEL = S.INVALID_TRANSACTION_CODE, S.INVALID_CHANNEL


def test_each_rule_and_its_rank(spark):
    cases = [
        (good(D1, "ok"), None),
        (good(D1, None), NULL),
        (good(D1, "   "), NULL),
        ((D1, "a1", None, "1", "PURCH01", "ONLINE"), NULL),
        ((D1, "a2", "A", None, "PURCH01", "ONLINE"), NULL),
        ((D1, "a3", "A", "1", " ", "ONLINE"), NULL),
        ((D1, "a4", "A", "1", "PURCH01", None), NULL),
        ((D1, "a5", "A", "1", "PURCH01", "ONLINE", "not a date"), NULL),
        ((D1, "a6", "A", "1", "PURCH01", "ONLINE", None), NULL),
        (good(D1, "b1", amount="0"), AMOUNT),
        (good(D1, "b2", amount="-5.00"), AMOUNT),
        (good(D1, "b3", amount="abc"), AMOUNT),
        (good(D1, "b4", amount="NaN"), AMOUNT),
        (good(D1, "b5", amount="1e30"), AMOUNT),
        (good(D1, "b6", amount="0.004"), None),
        (good(D1, "b7", amount="-0.004"), AMOUNT),
        (good(D1, "b8", amount="1.005"), None),
        (good(D1, "b9", amount="1.0000005"), AMOUNT),  # would be rounded
        (good(D1, "ba", amount="0.0000001"), AMOUNT),
        (good(D1, "bb", amount="123456789012345678.123456"), None),
        (good(D1, "bc", amount="1234567890123456789"), AMOUNT),
        (good(D1, "c1", code="XXX99"), CODE),
        (good(D1, "d1", channel="MOBILE"), CHANNEL),
        (good(D1, "d2", channel="online"), CHANNEL),
        # several defects: the first in rank wins
        ((D1, "e1", None, "-1", "XXX99", "MOBILE"), NULL),
        ((D1, "e2", "A", "-1", "XXX99", "MOBILE"), AMOUNT),
        ((D1, "e3", "A", "1", "XXX99", "MOBILE"), CODE),
    ]
    assert reasons(spark, [row for row, _ in cases]) == [reason for _, reason in cases]


def test_duplicates_across_dates(spark):
    cases = [
        (good(D1, "x"), None),
        (good(D2, "x"), DUPLICATE),
        (good(D3, "x", code="XXX99"), DUPLICATE),  # ranks before the code
        (good(D3, "x", amount="-1"), AMOUNT),  # ranks after the amount
        # a rejected row takes no id
        (good(D1, "y", channel="MOBILE"), CHANNEL),
        (good(D2, "y"), None),
        (good(D3, "y"), DUPLICATE),
    ]
    assert reasons(spark, [row for row, _ in cases]) == [reason for _, reason in cases]


def test_duplicates_within_a_date(spark):
    rows = [
        good(D1, "x", amount="2.00"),
        good(D1, "x", amount="1.00"),  # least by content goes in
        good(D1, "x", code="XXX99"),  # not acceptable: keeps its own reason
        good(D1, "z"),
        good(D1, "z"),  # full copy
        good(D1, "z"),
    ]
    verdicts = reasons(spark, rows)
    assert verdicts[:3] == [DUPLICATE, None, CODE]
    assert sorted(map(str, verdicts[3:])) == sorted(["None", DUPLICATE, DUPLICATE])


def test_order_of_a_date_can_be_given(spark):
    rows = [good(D1, "x", amount="2.00"), good(D1, "x", amount="1.00")]
    assert reasons(spark, rows, tie_break=["_row_id"]) == [None, DUPLICATE]


def test_ids_accepted_before_the_batch(spark):
    before = sample.bronze(spark, [good(D1, "x"), good(D1, "other")])
    rows = [good(D2, "x"), good(D2, "x", amount="-1"), good(D2, "new")]
    assert reasons(spark, rows, accepted_before=before) == [DUPLICATE, AMOUNT, None]


def test_accounts_count_from_their_first_date(spark):
    rows = [good(D1, "1"), good(D1, "2", account="B"), good(D2, "3", account="B"), good(D1, "4", account="C")]
    known = sample.known(spark, A=D1, B=D2)
    classified = classify_transactions(sample.bronze(spark, rows), sample.codes(spark), known)
    found = {r["transaction_id"]: r["_is_resolvable"] for r in classified.collect()}
    assert found == {"1": True, "2": False, "3": True, "4": False}
    # an unknown account is a flag, not a rejection
    assert classified.where(F.col("_rejection_reason").isNotNull()).isEmpty()


def test_a_repeated_code_does_not_multiply_rows(spark):
    codes = sample.codes(spark)
    rows = sample.bronze(spark, [good(D1, "1")])
    twice = codes.unionByName(codes.withColumn("description", F.lit("again")))
    assert classify_transactions(rows, twice, sample.known(spark, A=D1)).count() == 1


def test_promotion_signs_and_types(spark):
    rows = [
        good(D1, "debit", "12.50"),
        good(D1, "credit", "7.25", code="PAY01"),
        good(D1, "bad", channel="MOBILE"),
    ]
    classified = classify_transactions(
        sample.bronze(spark, rows), sample.codes(spark), sample.known(spark, A=D1)
    )
    silver = promote_transactions(classified, sample.RUN_ID, sample.NOW)
    assert silver.schema.names == S.SILVER_TRANSACTIONS.names
    assert [f.dataType for f in silver.schema] == [f.dataType for f in S.SILVER_TRANSACTIONS]
    signed = {r["transaction_id"]: r["_signed_amount"] for r in silver.collect()}
    assert signed == {"debit": Decimal("12.50"), "credit": Decimal("-7.25")}


def test_both_outcomes_come_from_one_frame(spark):
    rows = [good(D1, "ok"), good(D1, "bad", amount="abc"), good(D2, "ok")]
    classified = classify_transactions(
        sample.bronze(spark, rows), sample.codes(spark), sample.known(spark, A=D1)
    )
    split = split_by_disposition(classified, sample.RUN_ID, sample.NOW)
    found = {(r["transaction_id"], str(r["date"])): r for r in split.collect()}
    assert len(found) == 3
    bad = found[("bad", "2024-07-01")]
    assert (bad["disposition"], bad["_raw_amount"], bad["amount"]) == ("rejected", "abc", None)
    assert found[("ok", "2024-07-01")]["disposition"] == "accepted"
    assert found[("ok", "2024-07-02")]["_rejection_reason"] == DUPLICATE


def one_by_one(rows, known):
    """The rules applied date by date, row by row."""
    accepted, verdicts = set(), {}
    for day in sorted({row[0] for row in rows}):
        fresh = set()
        today = [(n, row) for n, row in enumerate(rows) if row[0] == day]
        for n, (_, ident, account, amount, code, channel) in today:
            if not ident or not account:
                verdict = NULL
            elif float(amount) <= 0:
                verdict = AMOUNT
            elif ident in accepted:
                verdict = DUPLICATE
            elif code == "XXX99":
                verdict = CODE
            elif channel == "MOBILE":
                verdict = CHANNEL
            elif ident in fresh:
                verdict = DUPLICATE
            else:
                verdict = None
                fresh.add(ident)
            verdicts[n] = (verdict, account in known and known[account] <= day)
        accepted |= fresh
    return verdicts


@pytest.mark.parametrize("seed", range(4))
def test_equals_a_date_by_date_load(spark, seed):
    pick = random.Random(seed)
    rows = [
        (
            D1 + timedelta(days=pick.randrange(5)),
            pick.choice([None, "", *map(str, range(40))]),
            pick.choice([None, "A", "B", "C"]),
            pick.choice(["5.00", "1.00", "-1.00", "0"]),
            pick.choice(["PURCH01", "PAY01", "XXX99"]),
            pick.choice(["ONLINE", "IN_STORE", "MOBILE"]),
        )
        for _ in range(400)
    ]
    known = {"A": D1, "B": D3}
    classified = classify_transactions(
        sample.bronze(spark, rows), sample.codes(spark), sample.known(spark, **known), tie_break=["_row_id"]
    )
    found = {r["_row_id"]: (r["_rejection_reason"], r["_is_resolvable"]) for r in classified.collect()}
    assert found == one_by_one(rows, known)


@pytest.mark.parametrize("cut", [1, 3])
def test_batches_in_turn_equal_one_batch(spark, cut):
    pick = random.Random(cut)
    rows = [
        (
            D1 + timedelta(days=pick.randrange(5)),
            str(pick.randrange(60)),
            "A",
            pick.choice(["5.00", "-1.00"]),
            pick.choice(["PURCH01", "XXX99"]),
            "ONLINE",
        )
        for _ in range(300)
    ]
    bronze, codes, known = sample.bronze(spark, rows), sample.codes(spark), sample.known(spark, A=D1)
    border = F.lit(D1 + timedelta(days=cut))

    def judge(part, before=None):
        return classify_transactions(part, codes, known, before, tie_break=["_row_id"])

    first = judge(bronze.where(F.col("date") < border))
    taken = first.where(F.col("_rejection_reason").isNull())
    second = judge(bronze.where(F.col("date") >= border), taken)
    columns = ["_row_id", "_rejection_reason"]
    in_turn = {tuple(r) for r in first.select(columns).unionByName(second.select(columns)).collect()}
    assert in_turn == {tuple(r) for r in judge(bronze).select(columns).collect()}


def test_one_id_and_one_account_in_most_rows(spark):
    """A hot id, a hot account and a hot code give whole, right results."""
    n = 30_000
    hot = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("transaction_id"),
        F.when(F.col("id") % 2 == 0, "A").otherwise(F.concat(F.lit("N"), "id")).alias("account_id"),
        F.lit("2024-07-01").alias("transaction_date"),
        F.lit("1.00").alias("amount"),
        F.lit("PURCH01").alias("transaction_code"),
        F.lit(None).cast("string").alias("merchant_name"),
        F.lit("ONLINE").alias("channel"),
        F.lit("f").alias("_source_file"),
        F.lit(sample.NOW).alias("_ingested_at"),
        F.lit(D1).alias("date"),
        F.col("id").alias("_row_id"),
    )
    classified = classify_transactions(hot, sample.codes(spark), sample.known(spark, A=D1))
    counts = {r[0]: r[1] for r in classified.groupBy("_rejection_reason").count().collect()}
    assert counts == {None: n - n // 3 + 1, DUPLICATE: n // 3 - 1}
