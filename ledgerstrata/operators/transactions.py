"""Transactions: prioritised rejection, resolvability and promotion.

The rule order is: missing field, bad amount, duplicate of an accepted
transaction, unknown code, bad channel. Dates are judged together, with the
outcome a date-by-date load would have: a row is a duplicate if its id was
accepted on an earlier date, or earlier in the order of the same date.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerstrata import schemas as S
from ledgerstrata.functions.rules import (
    as_amount,
    as_day,
    first_match,
    transaction_reference_rules,
    transaction_screen,
)
from ledgerstrata.functions.scalars import signed
from ledgerstrata.operators.codes import code_lookup

Keep = Callable[[DataFrame], DataFrame]


def _screened(bronze: DataFrame, codes: DataFrame, keep: Keep) -> DataFrame:
    """Rows with the verdicts that need no other transaction."""
    lookup = keep(code_lookup(codes, "debit_credit_indicator")).select(
        "transaction_code",
        F.col("debit_credit_indicator").alias("_indicator"),
        F.lit(True).alias("_code_known"),
    )
    code_known = F.coalesce(F.col("_code_known"), F.lit(False))
    return bronze.join(lookup, "transaction_code", "left").select(
        *bronze.columns,
        "_indicator",
        first_match(transaction_screen()).alias("_screen"),
        first_match(transaction_reference_rules(code_known)).alias("_reference"),
    )


def _acceptable() -> Column:
    return F.col("_screen").isNull() & F.col("_reference").isNull()


def _repeated_ids(
    screened: DataFrame, accepted_before: DataFrame | None, keep: Keep
) -> DataFrame:
    """Ids that may yield a duplicate: seen twice in the batch, or before it.

    The aggregate keeps fixed-width values only and folds inside each task, so an
    id that fills a third of the batch still shuffles as one row per task. The
    conditions stand inside the aggregates: as a filter they would be pushed below
    the screening and evaluated twice.
    """
    per_id = screened.groupBy("transaction_id").agg(
        F.count_if(F.col("_screen").isNull()).alias("_copies"),
        F.count_if(_acceptable()).alias("_candidates"),
        F.min(F.when(_acceptable(), F.col("date"))).alias("_first_date"),
    )
    if accepted_before is None:
        return per_id.where(F.col("_copies") > 1).select(
            "transaction_id", "_candidates", "_first_date", F.lit(False).alias("_seen")
        )
    # Only history ids that occur in the batch survive the semi join. With the
    # batch's ids stored, Spark knows their size: few are broadcast to the history
    # scan, and more of them can be a runtime Bloom filter ahead of its shuffle.
    per_id = keep(per_id).where(F.col("_copies") > 0)
    seen = (
        accepted_before.select("transaction_id")
        .join(per_id.select("transaction_id"), "transaction_id", "left_semi")
        .distinct()
        .withColumn("_seen", F.lit(True))
    )
    return (
        per_id.join(seen, "transaction_id", "left")
        .where((F.col("_copies") > 1) | F.col("_seen"))
        .select(
            "transaction_id",
            "_candidates",
            "_first_date",
            F.coalesce("_seen", F.lit(False)).alias("_seen"),
        )
    )


def _contends() -> Column:
    """Acceptable, first of its id by date, and not alone in that."""
    return (
        _acceptable()
        & (F.col("_candidates") > 1)
        & ~F.col("_seen")
        & (F.col("date") == F.col("_first_date"))
    )


def _rulings(
    screened: DataFrame, accepted_before: DataFrame | None, order: Column, keep: Keep
) -> DataFrame:
    """What the other transactions say about an id, one row per repeated id.

    `_winner` is the row that goes in where several acceptable ones share the id's
    first date. Only ids with such rows are looked at again, and their minimum
    folds inside each task.
    """
    repeated = keep(_repeated_ids(screened, accepted_before, keep))
    # Joining by date as well lets Spark skip the date partitions without a tie.
    tied = repeated.where((F.col("_candidates") > 1) & ~F.col("_seen")).select(
        "transaction_id", F.col("_first_date").alias("date")
    )
    winners = (
        screened.join(tied, ["transaction_id", "date"], "inner")
        .groupBy("transaction_id")
        .agg(F.min(F.when(_acceptable(), order)).alias("_winner"))
    )
    return keep(repeated.join(winners, "transaction_id", "left"))


def classify_transactions(
    bronze: DataFrame,
    codes: DataFrame,
    known_accounts: DataFrame,
    accepted_before: DataFrame | None = None,
    tie_break: Sequence[str] = S.TRANSACTION_SOURCE.names,
    keep: Keep = lambda rows: rows,
) -> DataFrame:
    """Bronze rows with `_rejection_reason`, `_is_resolvable` and `_indicator`.

    `known_accounts` is (account_id, known_from). `accepted_before` holds the ids
    in Silver outside the dates of this batch. `tie_break` orders acceptable rows
    of one id and date; full copies are told apart by `_row_id`, which must be
    unique in the batch.

    `keep` may store an intermediate result and return a scan of it. The result
    is then planned with its true size: the rulings, being small next to the
    batch, are broadcast and the batch itself is never shuffled by id. Too large for
    that, they meet the batch in a sort-merge join of two plain shuffles, the only
    form AQE splits at hot keys. Without `keep` the plan stays lazy but has neither.
    """
    screened = _screened(bronze, codes, keep)
    order = F.struct(*tie_break, "_row_id")
    rulings = _rulings(screened, accepted_before, order, keep)
    earlier = F.col("_seen") | (F.col("_first_date") < F.col("date"))
    beaten = _contends() & (order != F.col("_winner"))
    duplicate = F.lit(S.DUPLICATE_TRANSACTION_ID)
    reason = F.coalesce(
        F.col("_screen"),
        F.when(earlier, duplicate),
        F.col("_reference"),
        F.when(beaten, duplicate),
    )
    known = F.coalesce(F.col("known_from") <= F.col("date"), F.lit(False))
    return (
        screened.join(rulings, "transaction_id", "left")
        .join(known_accounts, "account_id", "left")
        .select(
            *bronze.columns,
            "_indicator",
            known.alias("_is_resolvable"),
            reason.alias("_rejection_reason"),
        )
    )


def promote_transactions(classified: DataFrame, run_id: str, now: datetime) -> DataFrame:
    """Silver rows: the accepted side of `split_by_disposition`."""
    both = split_by_disposition(classified, run_id, now)
    return both.where(F.col("disposition") == S.ACCEPTED).select(*S.SILVER_TRANSACTIONS.names)


def quarantine_transactions(classified: DataFrame, run_id: str, now: datetime) -> DataFrame:
    """Quarantine rows: the rejected side, with the raw fields under their own names."""
    both = split_by_disposition(classified, run_id, now).where(F.col("disposition") == S.REJECTED)
    raw = both.drop(*S.RAW_FIELDS).withColumnsRenamed({raw: name for name, raw in S.RAW_FIELDS.items()})
    return raw.select(*S.QUARANTINE_TRANSACTIONS.names)


def split_by_disposition(classified: DataFrame, run_id: str, now: datetime) -> DataFrame:
    """Accepted and rejected rows side by side, ready for one partitioned write.

    Both outcomes come from one evaluation of the classification, so they cannot
    disagree and the batch is neither classified twice nor kept in memory.
    """
    accepted = F.col("_rejection_reason").isNull()
    amount = as_amount("amount")
    stamp = F.lit(now).cast("timestamp")
    raw = {new: F.when(~accepted, F.col(old).cast("string")) for old, new in S.RAW_FIELDS.items()}
    typed = {
        "_signed_amount": F.when(accepted, signed(amount, F.col("_indicator"))),
        "_pipeline_run_id": F.lit(run_id),
        "_promoted_at": F.when(accepted, stamp),
        "_rejected_at": F.when(~accepted, stamp),
        "disposition": F.when(accepted, S.ACCEPTED).otherwise(S.REJECTED),
        "amount": F.when(accepted, amount),
        "transaction_date": F.when(accepted, as_day("transaction_date")),
    }
    return (
        classified.withColumnRenamed("_ingested_at", "_bronze_ingested_at")
        .withColumns(raw | typed)
        .select(
            *[c for c in S.SILVER_TRANSACTIONS.names if c != "date"],
            *raw,
            "_rejected_at",
            "_rejection_reason",
            "disposition",
            "date",
        )
    )
