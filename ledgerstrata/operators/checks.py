"""Data-quality checks. Each one counts violations; zero passes.

A missing table is never a pass: callers hand over scans with a fixed schema, and
`expect_rows` turns an empty table that must not be empty into a violation.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerstrata import schemas as S
from ledgerstrata.functions.scalars import is_monday, week_start

TOLERANCE = 0.001


# ---------------------------------------------------------------------------
# Building blocks
# ---------------------------------------------------------------------------
def result(check_id: str, violations: DataFrame, total: Column | None = None) -> DataFrame:
    """One row (check_id, violations) from a frame of violations."""
    counted = F.count("*") if total is None else F.coalesce(total, F.lit(0))
    return violations.agg(counted.cast("bigint").alias("violations")).select(
        F.lit(check_id).alias("check_id"), "violations"
    )


def row_checks(rows: DataFrame, predicates: Mapping[str, Column]) -> DataFrame:
    """Many row-level checks on one table in a single scan.

    A predicate describes a bad row. All of them become conditional counts of one
    aggregate, so the table is read once however many checks there are.
    """
    counts = rows.agg(*[F.count_if(bad).alias(name) for name, bad in predicates.items()])
    cells = [
        F.struct(F.lit(name).alias("check_id"), F.col(f"`{name}`").alias("violations"))
        for name in predicates
    ]
    return counts.select(F.inline(F.array(*cells)))


def combine(results: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, results)


def add_up(check_id: str, results: Iterable[DataFrame]) -> DataFrame:
    """One check out of several counts."""
    return result(check_id, combine(results), F.sum("violations"))


def not_in(column: str, allowed: Sequence[str], allow_null: bool = False) -> Column:
    outside = ~F.col(column).isin(*allowed)
    return outside if allow_null else F.col(column).isNull() | outside


def repeated(rows: DataFrame, *columns: str) -> DataFrame:
    """Keys that occur more than once."""
    return rows.groupBy(*columns).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def unmatched(rows: DataFrame, column: str, reference: DataFrame) -> DataFrame:
    """(value, n) for values without a partner; n rows carry each.

    Values are folded before the anti join: a value that a third of the rows share
    reaches it as one row. NULL has no partner and is reported.
    """
    values = rows.groupBy(column).agg(F.count("*").alias("n"))
    return values.join(reference.select(column), column, "left_anti")


def counts_differ(a: DataFrame, b: DataFrame, *by: str) -> DataFrame:
    """Keys for which two tables hold different numbers of rows."""
    left = a.groupBy(*by).agg(F.count("*").alias("a_rows"))
    right = b.groupBy(*by).agg(F.count("*").alias("b_rows"))
    return left.join(right, list(by), "full_outer").where(
        ~F.col("a_rows").eqNullSafe(F.col("b_rows"))
    )


def in_both(
    a: DataFrame, b: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Records of `a` that are in `b` too, NULLs comparing equal, with their count.

    Records meet by `keys` and a fingerprint of `columns`, so that whole rows are
    not shuffled. Which fields are NULL goes into the fingerprint, as hashing skips
    them. Repeats fold inside each task.
    """
    marks = [F.col(c).isNull() for c in columns]
    text = [F.col(c).cast("string") for c in columns]
    fingerprint = F.xxhash64(*text, *marks).alias("fingerprint")

    def side(rows: DataFrame, in_a: int, in_b: int) -> DataFrame:
        return rows.select(*keys, fingerprint, F.lit(in_a).alias("in_a"), F.lit(in_b).alias("in_b"))

    totals = (
        side(a, 1, 0)
        .unionByName(side(b, 0, 1))
        .groupBy(*keys, "fingerprint")
        .agg(F.sum("in_a").alias("in_a"), F.sum("in_b").alias("in_b"))
    )
    return totals.where((F.col("in_a") > 0) & (F.col("in_b") > 0))


def expect_rows(check_id: str, rows: DataFrame) -> DataFrame:
    """A violation if a table that must hold rows is empty or absent."""
    found = F.when(F.count("*") == 0, F.lit(1)).otherwise(F.lit(0))
    return result(check_id, rows.limit(1), found)


# ---------------------------------------------------------------------------
# Bronze
# ---------------------------------------------------------------------------
def b01(source_rows: DataFrame, bronze: DataFrame) -> DataFrame:
    return result("B-01", counts_differ(source_rows, bronze, "date"))


def b02(source_rows: DataFrame, bronze: DataFrame) -> DataFrame:
    return result("B-02", counts_differ(source_rows, bronze, "date"))


def b03(source_codes: DataFrame, bronze_codes: DataFrame) -> DataFrame:
    """How far the two row counts of the code table are apart."""
    one = source_codes.select(F.lit(1).alias("n")).unionAll(bronze_codes.select(F.lit(-1).alias("n")))
    return result("B-03", one, F.abs(F.sum("n")))


def b04(*bronze_tables: DataFrame) -> DataFrame:
    missing = F.col("_pipeline_run_id").isNull()
    return add_up("B-04", [row_checks(t, {"B-04": missing}) for t in bronze_tables])


def b05(bronze: DataFrame) -> DataFrame:
    return row_checks(bronze, {"B-05": F.col("amount").try_cast("double") < 0})


# ---------------------------------------------------------------------------
# Silver transactions
# ---------------------------------------------------------------------------
SILVER_TRANSACTION_ROW_CHECKS = {
    "ST-02": lambda: F.col("_signed_amount").isNull(),
    "ST-03": lambda: F.col("_is_resolvable").isNull(),
}


def st01(silver: DataFrame) -> DataFrame:
    return result("ST-01", repeated(silver, "transaction_id"))


def silver_row_checks(silver: DataFrame, *names: str) -> DataFrame:
    chosen = names or tuple(SILVER_TRANSACTION_ROW_CHECKS)
    return row_checks(silver, {n: SILVER_TRANSACTION_ROW_CHECKS[n]() for n in chosen})


def st04(reconciliation: DataFrame) -> DataFrame:
    return result("ST-04", reconciliation.where(F.col("delta") != 0))


def st05(rejects: DataFrame) -> DataFrame:
    return row_checks(rejects, {"ST-05": not_in("_rejection_reason", S.ALL_REASONS)})


def amounts_alike(rejects: DataFrame) -> DataFrame:
    """Rejects with the amounts that Silver could hold written as Silver writes them."""
    typed = F.col("amount").try_cast(S.AMOUNT).cast("string")
    return rejects.withColumn("amount", F.coalesce(typed, F.col("amount").cast("string")))


def st06(silver: DataFrame, rejects: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Silver records that were rejected as well.

    Rejected duplicates are left out: they share an id with Silver by definition.
    """
    others = rejects.where(F.col("_rejection_reason") != S.DUPLICATE_TRANSACTION_ID)
    shared = in_both(silver, others, ("date", "transaction_id"), columns)
    return result("ST-06", shared, F.sum("in_a"))


def _successful_runs(log: DataFrame, *models: str) -> DataFrame:
    done = F.col("status") == S.SUCCESS
    if models:
        done = done & F.col("model_name").isin(*models)
    return log.where(done).select(F.col("run_id").alias("_pipeline_run_id")).distinct()


def st07(silver: DataFrame, log: DataFrame) -> DataFrame:
    runs = _successful_runs(log, "silver_transactions")
    return result("ST-07", unmatched(silver, "_pipeline_run_id", runs))


def st08(silver: DataFrame, codes: DataFrame) -> DataFrame:
    return result("ST-08", unmatched(silver, "transaction_code", codes), F.sum("n"))


def st09(reconciliation: DataFrame) -> DataFrame:
    return result("ST-09", reconciliation, F.abs(F.sum("delta")))


# ---------------------------------------------------------------------------
# Silver accounts
# ---------------------------------------------------------------------------
def sa01(accounts: DataFrame) -> DataFrame:
    return result("SA-01", repeated(accounts, "account_id"))


ACCOUNT_ROW_CHECKS = {
    "SA-02": lambda: F.col("_pipeline_run_id").isNull(),
    "SA-03": lambda: F.col("_record_valid_from").isNull(),
    "SA-04": lambda: not_in("account_status", S.ACCOUNT_STATUSES),
}
ACCOUNT_REJECT_CHECKS = {
    "SA-05": lambda: F.col("_rejection_reason").isNull(),
    "SA-06": lambda: not_in("_rejection_reason", S.ACCOUNT_REASONS),
}


def account_row_checks(accounts: DataFrame, *names: str) -> DataFrame:
    chosen = names or tuple(ACCOUNT_ROW_CHECKS)
    return row_checks(accounts, {n: ACCOUNT_ROW_CHECKS[n]() for n in chosen})


def account_reject_checks(rejects: DataFrame, *names: str) -> DataFrame:
    chosen = names or tuple(ACCOUNT_REJECT_CHECKS)
    return row_checks(rejects, {n: ACCOUNT_REJECT_CHECKS[n]() for n in chosen})


# ---------------------------------------------------------------------------
# Gold
# ---------------------------------------------------------------------------
def spine_mismatch(silver: DataFrame, daily: DataFrame) -> DataFrame:
    """Dates only one side has, with the side that lacks them."""
    spine = silver.select("transaction_date").distinct().withColumn("in_silver", F.lit(True))
    gold = daily.select("transaction_date").withColumn("in_gold", F.lit(True))
    side = F.when(F.col("in_gold").isNull(), "MISSING_IN_GOLD").when(
        F.col("in_silver").isNull(), "MISSING_IN_SILVER"
    )
    return (
        spine.join(gold, "transaction_date", "full_outer")
        .select("transaction_date", side.alias("mismatch"))
        .where(F.col("mismatch").isNotNull())
    )


def g01(silver: DataFrame, daily: DataFrame) -> DataFrame:
    return result("G-01", spine_mismatch(silver, daily))


def _expected_daily(silver: DataFrame) -> DataFrame:
    return (
        silver.where(F.col("_is_resolvable"))
        .groupBy("transaction_date")
        .agg(F.count("*").alias("expected_n"), F.sum("_signed_amount").alias("expected_sum"))
    )


def daily_totals_checks(silver: DataFrame, daily: DataFrame, *names: str) -> DataFrame:
    """G-02 and G-03 from one aggregate of Silver; a date that Gold has lost counts as well."""
    joined = daily.join(_expected_daily(silver), "transaction_date", "full_outer")
    off_by = F.coalesce("total_signed_amount", F.lit(0)) - F.coalesce("expected_sum", F.lit(0))
    predicates = {
        "G-02": F.coalesce("total_transactions", F.lit(0)) != F.coalesce("expected_n", F.lit(0)),
        "G-03": F.abs(off_by) > TOLERANCE,
    }
    return row_checks(joined, {n: predicates[n] for n in names or tuple(predicates)})


def g04(silver: DataFrame, codes: DataFrame, weekly: DataFrame) -> DataFrame:
    """Weekly purchase counts against Silver, both ways: a lost or a surplus week row counts."""
    kinds = codes.select("transaction_code", "transaction_type").distinct()
    expected = (
        silver.where(F.col("_is_resolvable"))
        .join(kinds, "transaction_code", "inner")
        .groupBy("account_id", week_start(F.col("transaction_date")).alias("week_start_date"))
        .agg(F.count_if(F.col("transaction_type") == "PURCHASE").alias("expected_n"))
    )
    joined = weekly.join(expected, ["account_id", "week_start_date"], "full_outer")
    wrong = ~F.col("total_purchases").eqNullSafe(F.col("expected_n"))
    return row_checks(joined, {"G-04": wrong})


WEEKLY_ROW_CHECKS = {
    "G-05": lambda: ~is_monday(F.col("week_start_date")),
    "G-06": lambda: F.col("week_end_date") != F.date_add("week_start_date", 6),
}


def weekly_row_checks(weekly: DataFrame, *names: str) -> DataFrame:
    chosen = names or tuple(WEEKLY_ROW_CHECKS)
    return row_checks(weekly, {n: WEEKLY_ROW_CHECKS[n]() for n in chosen})


def g07(daily: DataFrame, weekly: DataFrame) -> DataFrame:
    missing = F.col("_pipeline_run_id").isNull()
    return add_up("G-07", [row_checks(t, {"G-07": missing}) for t in (daily, weekly)])


# ---------------------------------------------------------------------------
# Idempotency, audit trail, order of processing
# ---------------------------------------------------------------------------
def i01(differing_metrics: DataFrame) -> DataFrame:
    return result("I-01", differing_metrics)


def at01(control: DataFrame, expected) -> DataFrame:
    """The watermark stands at the expected date; no control row is a violation."""
    stands = F.count_if(F.col("last_processed_date") == F.lit(expected).cast("date")) == 1
    exact = stands & (F.count("*") == 1)
    return result("AT-01", control, F.when(exact, F.lit(0)).otherwise(F.lit(1)))


def _untraced(check_id: str, tables: Mapping[str, DataFrame], log: DataFrame) -> DataFrame:
    """Distinct run ids of a layer without a success of that very model."""
    runs = combine(
        t.select("_pipeline_run_id").distinct().withColumn("model_name", F.lit(model))
        for model, t in tables.items()
    )
    done = (
        log.where(F.col("status") == S.SUCCESS)
        .select(F.col("run_id").alias("_pipeline_run_id"), "model_name")
        .distinct()
    )
    lost = runs.join(done, ["_pipeline_run_id", "model_name"], "left_anti")
    return result(check_id, lost.select("_pipeline_run_id").distinct())


def at02(transactions: DataFrame, accounts: DataFrame, codes: DataFrame, log: DataFrame) -> DataFrame:
    tables = {
        "bronze_transactions": transactions,
        "bronze_accounts": accounts,
        "bronze_transaction_codes": codes,
    }
    return _untraced("AT-02", tables, log)


def at03(daily: DataFrame, weekly: DataFrame, log: DataFrame) -> DataFrame:
    tables = {"gold_daily_summary": daily, "gold_weekly_account_summary": weekly}
    return _untraced("AT-03", tables, log)


def or01(processed_dates: DataFrame, readiness: DataFrame) -> DataFrame:
    """Processed dates whose accounts were not ready."""
    ready = readiness.where(F.col("accounts_ready")).select(F.col("processing_date").alias("date"))
    return result("OR-01", processed_dates.join(ready, "date", "left_anti"))


# ---------------------------------------------------------------------------
# Declared column tests
# ---------------------------------------------------------------------------
DECLARED_NOT_NULL = {
    "silver_transaction_codes": ("transaction_code", "_pipeline_run_id"),
    "silver_accounts": ("account_id", "_pipeline_run_id"),
    "silver_transactions": (
        "transaction_id",
        "_signed_amount",
        "_pipeline_run_id",
        "_is_resolvable",
    ),
    "gold_daily_summary": ("transaction_date", "_pipeline_run_id"),
    "gold_weekly_account_summary": ("week_start_date", "account_id", "_pipeline_run_id"),
}
DECLARED_UNIQUE = {
    "silver_transaction_codes": "transaction_code",
    "silver_accounts": "account_id",
    "gold_daily_summary": "transaction_date",
}


def declared_tests(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The sixteen column tests, ids `DT-<table>-<column>-<kind>`."""
    results = []
    for table, columns in DECLARED_NOT_NULL.items():
        predicates = {f"DT-{table}-{c}-not_null": F.col(c).isNull() for c in columns}
        results.append(row_checks(tables[table], predicates))
    for table, column in DECLARED_UNIQUE.items():
        keyed = tables[table].where(F.col(column).isNotNull())
        results.append(result(f"DT-{table}-{column}-unique", repeated(keyed, column)))
    return combine(results)


def indicator_values(codes: DataFrame) -> DataFrame:
    """Debit/credit indicators outside the two known ones."""
    return row_checks(codes, {"TC-01": not_in("debit_credit_indicator", (S.DEBIT, S.CREDIT))})
