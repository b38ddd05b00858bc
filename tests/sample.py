"""Small inputs for the tests."""

from __future__ import annotations

import os
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import types as T

from ledgerstrata import schemas as S
from ledgerstrata.sources.tables import small_table

RUN_ID = "20240201_00000001"
NOW = datetime(2024, 2, 1, tzinfo=timezone.utc)
D1, D2, D3 = date(2024, 7, 1), date(2024, 7, 2), date(2024, 7, 3)

# An invented week: for each day three good rows, one of an account that no extract
# holds, and one that is rejected, as (account, amount, code, channel).
WEEK = [
    ["1 18.40 PURCH01 IN_STORE", "2 7.15 FEE01 ONLINE", "1 260.00 PAY01 IN_STORE", "X 33.10 PURCH01 ONLINE",
     "2 12.00 PURCH01 KIOSK"],
    ["2 91.25 PURCH01 ONLINE", "3 14.60 PURCH01 IN_STORE", "1 5.05 INT01 ONLINE", "X 8.80 PAY01 ONLINE",
     "1 64.00 REFUND9 ONLINE"],
    ["1 310.75 PAY01 ONLINE", "2 48.90 PURCH01 IN_STORE", "1 27.35 PURCH01 ONLINE", "X 102.45 PURCH01 IN_STORE",
     "2 1.2.3 PURCH01 ONLINE"],
    ["3 9.99 FEE01 IN_STORE", "1 133.20 PURCH01 ONLINE", "2 21.50 PURCH01 ONLINE", "X 56.65 FEE01 ONLINE",
     "3 none PURCH01 ONLINE"],
    ["2 405.10 PAY01 ONLINE", "3 76.80 PURCH01 IN_STORE", "3 11.45 INT01 ONLINE", "X 19.30 PURCH01 ONLINE",
     "1 40.00 PURCH01 PHONE"],
    ["1 62.70 PURCH01 IN_STORE", "2 3.85 INT01 IN_STORE", "3 189.00 PAY01 IN_STORE", "X 71.15 PURCH01 ONLINE",
     "1 0.00 PURCH01 ONLINE"],
    ["3 24.95 PURCH01 ONLINE", "1 150.60 PAY01 IN_STORE", "2 37.05 PURCH01 IN_STORE", "X 4.40 INT01 ONLINE",
     "2 15.00 CASH77 IN_STORE"],
]
# Balance of accounts 1, 2, 3 after each day; account 3 opens on day two.
BALANCES = [
    ("318.22", "1904.10", None),
    ("323.27", "1995.35", "514.60"),
    ("39.87", "2044.25", "514.60"),
    ("173.07", "2065.75", "524.59"),
    ("173.07", "1660.65", "612.84"),
    ("235.77", "1664.50", "423.84"),
    ("85.17", "1701.55", "448.79"),
]
CODES = """transaction_code,description,debit_credit_indicator,transaction_type,affects_balance
PURCH01,Purchase,DR,PURCHASE,true
PAY01,Payment,CR,PAYMENT,true
FEE01,Annual Fee,DR,FEE,true
INT01,Interest Charge,DR,INTEREST,true
"""


def write(path: str, lines: list[str]) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        out.write("\n".join(lines) + "\n")


def write_transactions(folder: str, day: date, rows: list[str]) -> None:
    write(f"{folder}/transactions_{day}.csv", [",".join(S.TRANSACTION_SOURCE.names), *rows])


def write_accounts(folder: str, day: date, rows: list[str]) -> None:
    write(f"{folder}/accounts_{day}.csv", [",".join(S.ACCOUNT_SOURCE.names), *rows])


def write_codes(folder: str) -> None:
    write(f"{folder}/transaction_codes.csv", CODES.strip().split("\n"))


def week_rows(day: date) -> list[str]:
    rows = []
    for n, entry in enumerate(WEEK[(day - D1).days], start=1):
        account, amount, code, channel = entry.split()
        rows.append(f"T-{day.day}-{n},L-{account},{day},{amount},{code},,{channel}")
    return rows


def account_rows(day: date) -> list[str]:
    return [
        f"L-{n},Holder {n},ACTIVE,2500.00,{balance},2021-09-30,2024-07-01,2024-07-31"
        for n, balance in enumerate(BALANCES[(day - D1).days], start=1)
        if balance is not None
    ]


def write_week(folder: str, days: int = 7) -> None:
    write_codes(folder)
    for i in range(days):
        day = D1 + timedelta(days=i)
        write_transactions(folder, day, week_rows(day))
        write_accounts(folder, day, account_rows(day))


BRONZE = T.StructType(
    S.BRONZE_TRANSACTIONS.fields + [T.StructField("_row_id", T.LongType())]
)


def bronze(spark, rows: list[tuple]):
    """Bronze transactions from (date, id, account, amount, code, channel[, own date])."""
    full = []
    for n, row in enumerate(rows):
        day, ident, account, amount, code, channel = row[:6]
        own = row[6] if len(row) > 6 else str(day)
        source = f"transactions_{day}.csv"
        full.append((ident, account, own, amount, code, None, channel, source, NOW, RUN_ID, day, n))
    return small_table(spark, full, BRONZE)


def codes(spark):
    rows = [
        (*line.split(",")[:4], True, "transaction_codes.csv", NOW, RUN_ID)
        for line in CODES.strip().split("\n")[1:]
    ]
    return small_table(spark, rows, S.SILVER_CODES)


def known(spark, **first_dates: date):
    schema = T.StructType(
        [T.StructField("account_id", T.StringType()), T.StructField("known_from", T.DateType())]
    )
    return small_table(spark, list(first_dates.items()), schema)
