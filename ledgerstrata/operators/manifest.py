"""Manifests: what each write left in a table, by date, as row counts and order-free fingerprints.

An entry names a table and a date, the rows it holds, the sum of their hashes, and the
version (rows and fingerprint) of the input it was made from. The newest entry of a
table and date is its version. Versions are compared instead of rows: a date whose input
has moved on is stale.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ledgerstrata import schemas as S


def row_hash(columns: Iterable[str]) -> Column:
    """A 64-bit hash of a row; where NULLs stand counts too."""
    columns = list(columns)
    return F.xxhash64(*columns, *(F.col(c).isNull() for c in columns))


def fingerprint(columns: Iterable[str]) -> Column:
    """Sum of the row hashes: the same rows in any order, and in any files, give the same."""
    total = F.sum(row_hash(columns).cast("decimal(20,0)"))
    return F.coalesce(total, F.lit(0)).cast(S.FINGERPRINT)


def by_file(rows: DataFrame, columns: Iterable[str], own: Column | None = None) -> DataFrame:
    """Rows and fingerprint of every file of a scan that has `date` as a column.

    `own` tells the rows of one write; how many there are comes as `own`.
    """
    return _counted(rows, columns, own, "date", F.col("_metadata.file_name").alias("file"))


def by_date(rows: DataFrame, columns: Iterable[str], own: Column | None = None) -> DataFrame:
    return _counted(rows, columns, own, "date")


def _counted(rows: DataFrame, columns: Iterable[str], own: Column | None, *keys: str | Column) -> DataFrame:
    marks = [] if own is None else [F.count_if(own).alias("own")]
    return rows.groupBy(*keys).agg(
        F.count("*").alias("rows"), fingerprint(columns).alias("fingerprint"), *marks
    )


def entries(
    counted: Iterable[Row],
    table: str,
    days: Iterable[date],
    run_id: str,
    now: datetime,
    inputs: Iterable[Row] = (),
) -> list[tuple]:
    """Manifest rows of one write: every given day has one, also without a row in the table.

    `counted` are rows of `by_file` or `by_date`, and `inputs` the versions (date, rows,
    fingerprint) the days were made from: some values per date, never rows of a table.
    """
    found: dict[date, list[tuple]] = {day: [] for day in days}
    for row in counted:
        if row["date"] in found:
            found[row["date"]].append((row["file"] if "file" in row else None, row["rows"], row["fingerprint"]))
    made_from = {row["date"]: (row["rows"], row["fingerprint"]) for row in inputs}
    return [
        (table, day, *left, *made_from.get(day, (None, None)), run_id, now)
        for day, parts in found.items()
        for left in parts or [(None, 0, Decimal(0))]
    ]


def newest(manifest: DataFrame, *tables: str) -> DataFrame:
    """The entries of the last write of each table and date."""
    mine = manifest.where(F.col("table_name").isin(*tables))
    last = mine.groupBy("table_name", "date").agg(F.max("recorded_at").alias("recorded_at"))
    return mine.join(last, ["table_name", "date", "recorded_at"], "left_semi")


def versions_of(manifest: DataFrame, *tables: str) -> DataFrame:
    """One row for each of the tables and its dates: table_name, date, and the version."""
    return newest(manifest, *tables).groupBy("table_name", "date").agg(
        F.sum("rows").alias("rows"),
        F.sum("fingerprint").cast(S.FINGERPRINT).alias("fingerprint"),
        F.max("input_rows").alias("input_rows"),
        F.max("input_fingerprint").alias("input_fingerprint"),
        F.max("recorded_at").alias("recorded_at"),
    )


def versions(manifest: DataFrame, table: str) -> DataFrame:
    """(date, rows, fingerprint, input_rows, input_fingerprint, recorded_at) of one table."""
    return versions_of(manifest, table).drop("table_name")


def holds(made: Row | None, source: Row | None) -> bool:
    """`current` for one date: whether a version was made from this version of its input."""
    if made is None or source is None:
        return False
    return (made["input_rows"], made["input_fingerprint"]) == (source["rows"], source["fingerprint"])


def current(made: DataFrame, inputs: DataFrame) -> DataFrame:
    """Versions of `made` whose input is still what they were made from."""
    now = inputs.select(
        "date", F.col("rows").alias("_rows"), F.col("fingerprint").alias("_fingerprint")
    )
    same = F.col("input_rows").eqNullSafe(F.col("_rows")) & F.col("input_fingerprint").eqNullSafe(
        F.col("_fingerprint")
    )
    return made.join(now, "date").where(same).drop("_rows", "_fingerprint")


def audit(expected: DataFrame, found: DataFrame) -> DataFrame:
    """(date, bronze_rows, sound): the files of a manifest against (date, file, rows) on disk.

    A file that is missing, unreadable, cut or not in the manifest makes its date unsound,
    and its row count unknown.
    """
    wanted = expected.where(F.col("file").isNotNull()).select("date", "file", F.col("rows").alias("_wanted"))
    there = found.select("date", "file", F.col("rows").alias("_found"))
    paired = wanted.join(there, ["date", "file"], "full_outer")
    per_date = paired.groupBy("date").agg(
        F.sum("_found").alias("bronze_rows"),
        F.bool_and(F.col("_wanted").eqNullSafe(F.col("_found"))).alias("sound"),
    )
    return per_date.withColumn("bronze_rows", F.when(F.col("sound"), F.col("bronze_rows")))


def compare(first: DataFrame, second: DataFrame) -> DataFrame:
    """Tables and dates whose versions differ between two manifests, as rows and fingerprints."""
    sides = []
    for manifest, side in ((first, "first"), (second, "second")):
        last = newest(manifest, *S.FINGERPRINTED)
        sides.append(
            last.groupBy("table_name", "date").agg(
                F.sum("rows").alias(f"{side}_rows"), F.sum("fingerprint").alias(f"_{side}")
            )
        )
    differ = ~F.col("_first").eqNullSafe(F.col("_second")) | ~F.col("first_rows").eqNullSafe(
        F.col("second_rows")
    )
    return sides[0].join(sides[1], ["table_name", "date"], "full_outer").where(differ).drop("_first", "_second")
