"""Dated CSV extracts: `<entity>_YYYY-MM-DD.csv`, one file or folder per day.

A large day may be a folder of part files; the processing date is read from
whichever path element carries the extract's name.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstrata.functions.scalars import extract_date
from ledgerstrata.sources.tables import is_missing_path

NAME_PATTERN = r"([A-Za-z]+_\d{4}-\d{2}-\d{2}\.csv)"
DAY_GLOB = "[0-9][0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9]"
#: Prefix of a day's folder if extracts are written with `partitionBy("extract")`.
WRITTEN = "extract="
ROOT_PATTERN = r"^(.*_\d{4}-\d{2}-\d{2}\.csv)"
FILE_LIST = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("_source_file", T.StringType()),
        T.StructField("path", T.StringType()),
    ]
)


# How Spark names the faults of a CSV file in its errors.
FILE_FAULTS = ("MALFORMED_RECORD_IN_PARSING", "CSV header does not conform", "FAILED_READ_FILE")


def is_broken_extract(error: Exception) -> bool:
    """Whether an error is the fault of a file: its header, its rows or its encoding."""
    return any(fault in str(error) for fault in FILE_FAULTS)


def _places(source: str, entity: str, named: str) -> str:
    """Extracts by their exact names, also as written by a partitioned writer."""
    return f"{source}/{{{entity},{WRITTEN}{entity}}}_{named}.csv"


def _source_file(path: Column) -> Column:
    """Extract name inside a path; the bare file name for undated files."""
    named = F.regexp_extract(path, NAME_PATTERN, 1)
    return F.when(named == "", F.element_at(F.split(path, "/"), -1)).otherwise(named)


def _read_csv(
    spark: SparkSession, paths: list[str] | str, schema: T.StructType, multi_line: bool = False
) -> DataFrame:
    # enforceSchema=False makes Spark compare header names with the schema, so
    # a file with moved or renamed columns fails instead of shifting values. A
    # doubled quote stands for one, and a row of too few or too many fields fails.
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .option("multiLine", multi_line)
        .csv(paths)
    )


def list_extracts(
    spark: SparkSession, source: str, entity: str, days: Sequence[date] | None = None
) -> DataFrame:
    """Extracts of one entity as (date, _source_file, path); no content is read.

    A day of many part files is one row with the path of its folder. The days asked
    for are named in the listing itself, so that a daily run does not list every year.
    Names must match in full: a stray `old_transactions_…` is no extract.
    """
    named = DAY_GLOB if days is None else "{" + ",".join(day.isoformat() for day in days) + "}"
    if days is not None and not days:
        return spark.createDataFrame([], FILE_LIST)
    try:
        files = spark.read.format("binaryFile").load(_places(source, entity, named))
    except Exception as error:
        if is_missing_path(error):
            return spark.createDataFrame([], FILE_LIST)
        raise
    listed = (
        files.select(F.regexp_extract("path", ROOT_PATTERN, 1).alias("path"))
        .distinct()
        .select(
            extract_date(F.col("path")).alias("date"),
            _source_file(F.col("path")).alias("_source_file"),
            "path",
        )
        .where(F.col("date").isNotNull())
    )
    return listed if days is None else listed.where(F.col("date").isin(list(days)))


def scan_extracts(
    spark: SparkSession, paths: list[str] | str, schema: T.StructType, multi_line: bool = False
) -> DataFrame:
    """Rows of dated extracts with `_source_file` and the `date` of the file.

    `multi_line` allows line breaks inside quotes; each file is then read by one task.
    Without it such a row has too few fields and its day fails.
    """
    if not paths:
        typed = T.StructType(schema.fields + FILE_LIST.fields[1::-1])
        return spark.createDataFrame([], typed)
    rows = _read_csv(spark, paths, schema, multi_line)
    path = F.col("_metadata.file_path")
    return rows.select(
        *schema.names,
        _source_file(path).alias("_source_file"),
        extract_date(path).alias("date"),
    )


def scan_entity(
    spark: SparkSession, source: str, entity: str, schema: T.StructType
) -> DataFrame:
    """Every extract of one entity below a folder, in one job."""
    return scan_extracts(spark, _places(source, entity, DAY_GLOB), schema)


def scan_static(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """An undated reference file."""
    rows = _read_csv(spark, path, schema)
    return rows.select(*schema.names, F.lit(path.rsplit("/", 1)[-1]).alias("_source_file"))


def source_counts(rows: DataFrame) -> DataFrame:
    """Rows per source file."""
    return rows.groupBy("date", "_source_file").agg(F.count("*").alias("source_rows"))


def calendar(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day, both ends included."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return spark.range(1).select(F.explode(days).alias("date"))


def missing_dates(days: DataFrame, present: DataFrame) -> DataFrame:
    """Days of a calendar for which no extract arrived."""
    return days.select("date").join(present.select("date").distinct(), "date", "left_anti")
