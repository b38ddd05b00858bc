"""Scalar expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerstrata import schemas as S

# Patterns of the dated extracts and of the error-text scrubber.
EXTRACT_DATE_PATTERN = r"_(\d{4}-\d{2}-\d{2})\.csv"
UNIX_PATH_PATTERN = r"/\S+"
DRIVE_PATH_PATTERN = r"[A-Za-z]:\\\S+"
PATH_TOKEN = "<path>"
ERROR_TEXT_LIMIT = 500


def week_start(day: Column) -> Column:
    """Monday of the ISO week."""
    return F.trunc(day, "week")


def week_end(day: Column) -> Column:
    return F.date_add(week_start(day), 6)


def is_monday(day: Column) -> Column:
    return F.weekday(day) == 0


def signed(amount: Column, indicator: Column) -> Column:
    """Debits count up; anything that is not a debit counts down."""
    return F.when(indicator == S.DEBIT, amount).otherwise(-amount)


def sum_when(predicate: Column, value: Column) -> Column:
    return F.sum(F.when(predicate, value))


def gold_money(value: Column) -> Column:
    return value.cast(S.GOLD_MONEY)


def gold_money_or_zero(value: Column) -> Column:
    return F.coalesce(gold_money(value), F.lit(0).cast(S.GOLD_MONEY))


def scrub_error(text: Column) -> Column:
    """Replace file-system paths and keep at most 500 characters."""
    scrubbed = F.regexp_replace(text, UNIX_PATH_PATTERN, PATH_TOKEN)
    scrubbed = F.regexp_replace(scrubbed, DRIVE_PATH_PATTERN, PATH_TOKEN)
    return F.trim(F.substring(scrubbed, 1, ERROR_TEXT_LIMIT))


def extract_date(path: Column) -> Column:
    """Processing date carried by an extract's name; NULL if it has none."""
    return F.regexp_extract(path, EXTRACT_DATE_PATTERN, 1).try_cast("date")


def has_day_shape(text: Column) -> Column:
    """Ten characters with dashes in their places and a digit at the end: what else a cast reads as a date is shorter,
    longer or ends in a blank or a T. A pattern would cost more than all other rules of a row."""
    last = F.substring(text, 10, 1)
    dashes = (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")
    return (F.length(text) == 10) & dashes & (last >= "0") & (last <= "9")


def is_iso_day(text: Column) -> Column:
    return has_day_shape(text) & text.try_cast("date").isNotNull()
