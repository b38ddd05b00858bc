"""Validation predicates and first-match classification."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerstrata import schemas as S
from ledgerstrata.functions.scalars import has_day_shape


def is_blank(name: str) -> Column:
    """NULL, or nothing but spaces once read as text."""
    col = F.col(name)
    return col.isNull() | (F.trim(col.cast("string")) == "")


def any_of(predicates: Iterable[Column]) -> Column:
    return reduce(Column.__or__, predicates)


def first_match(rules: Iterable[tuple[str, Column]]) -> Column:
    """Name of the first rule that holds; NULL when none does."""
    return F.coalesce(*[F.when(predicate, F.lit(name)) for name, predicate in rules])


def as_money(name: str) -> Column:
    return F.col(name).try_cast(S.MONEY)


def as_amount(name: str) -> Column:
    return F.col(name).try_cast(S.AMOUNT)


def as_day(name: str) -> Column:
    """The day of a full ISO date; NULL for anything shorter or longer, such as a bare year."""
    text = F.col(name).cast("string")
    return F.when(has_day_shape(text), text.try_cast("date"))


def is_blank_number(name: str) -> Column:
    """`is_blank` that reads a number as text only where it is not one."""
    return F.col(name).isNull() | (as_amount(name).isNull() & is_blank(name))


def not_positive(name: str) -> Column:
    """Not a number, not above zero, or not to be kept in an amount column as it is.

    The column holds six decimals and eighteen digits before them. A number that is finer
    or larger would change on its way to Silver, so it is rejected, where it is counted.
    """
    amount = as_amount(name)
    finer = F.col(name).try_cast("decimal(38,18)")
    return amount.isNull() | (amount <= 0) | ~amount.eqNullSafe(finer)


def transaction_screen() -> list[tuple[str, Column]]:
    """Rules a transaction must pass before duplicates are looked at."""
    required = [
        is_blank("transaction_id"),
        is_blank("account_id"),
        as_day("transaction_date").isNull(),
        is_blank_number("amount"),
        is_blank("transaction_code"),
        is_blank("channel"),
    ]
    return [
        (S.NULL_REQUIRED_FIELD, any_of(required)),
        (S.INVALID_AMOUNT, not_positive("amount")),
    ]


def transaction_reference_rules(code_known: Column) -> list[tuple[str, Column]]:
    """Rules that rank after duplicates: reference code, then channel."""
    return [
        (S.INVALID_TRANSACTION_CODE, ~code_known),
        (S.INVALID_CHANNEL, ~F.col("channel").isin(*S.CHANNELS)),
    ]


def account_rules() -> list[tuple[str, Column]]:
    """The customer name is optional; every other account field is required."""
    required = [
        is_blank("account_id"),
        as_day("open_date").isNull(),
        as_money("credit_limit").isNull(),
        as_money("current_balance").isNull(),
        as_day("billing_cycle_start").isNull(),
        as_day("billing_cycle_end").isNull(),
        is_blank("account_status"),
    ]
    return [
        (S.NULL_REQUIRED_FIELD, any_of(required)),
        (S.INVALID_ACCOUNT_STATUS, ~F.col("account_status").isin(*S.ACCOUNT_STATUSES)),
    ]
