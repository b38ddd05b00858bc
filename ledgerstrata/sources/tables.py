"""Parquet tables: empty-safe scans, partition replacement, staged publishing."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable
from datetime import date

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


#: Prefix of the folders that hold the versions of a replaced table.
VERSION = "version-"


def is_missing_path(error: Exception) -> bool:
    return (
        isinstance(error, AnalysisException) and error.getCondition() == "PATH_NOT_FOUND"
    )


def configure(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # Rulings too large for a broadcast meet the batch by hash if each part of them is small, so that the batch,
    # which is far larger, is not sorted. Decided from the sizes written; skewed parts are split all the same.
    spark.conf.set("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m")
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach.

    The cluster names its shared folder in `spark.checkpoint.dir`. Only a local
    session, whose one process sees every path, may fall back to a temp folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="ledgerstrata-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def small_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A few driver-made rows (log entries, the watermark) as a local relation.

    Handed over as Arrow they need no Python worker and have a known size.
    """
    records = [dict(zip(schema.names, row)) for row in rows]
    arrow = pa.Table.from_pylist(records, schema=to_arrow_schema(schema))
    return spark.createDataFrame(arrow, schema)


# ---------------------------------------------------------------------------
# Scans
# ---------------------------------------------------------------------------
def scan_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of a (possibly date-partitioned) table; a typed empty one if absent."""
    try:
        return spark.read.schema(schema).parquet(current_path(spark, path))
    except AnalysisException as error:
        if is_missing_path(error):
            return spark.createDataFrame([], schema)
        raise


def scan_partition(
    spark: SparkSession, path: str, schema: T.StructType, day: date
) -> DataFrame:
    """One date of a table; the other partitions are never listed as splits."""
    return scan_table(spark, path, schema).where(F.col("date") == F.lit(day))


def row_address() -> Column:
    """Physical place of a row in its Parquet file.

    Unlike a generated id it stays the same after a retry or a lost executor, so
    two scans of one table agree on it.
    """
    return F.struct("_metadata.file_path", "_metadata.row_index")


def scan_addressed(
    spark: SparkSession, path: str, schema: T.StructType
) -> DataFrame:
    """`scan_table` with the row address as `_row_id`."""
    if not table_exists(spark, path):
        return spark.createDataFrame([], schema).withColumn("_row_id", F.lit(0))
    return scan_table(spark, path, schema).withColumn("_row_id", row_address())


# ---------------------------------------------------------------------------
# File-system steps (Hadoop API, so any cluster store works)
# ---------------------------------------------------------------------------
def _hadoop_path(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hadoop_path.getFileSystem(conf), hadoop_path


def table_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _hadoop_path(spark, current_path(spark, path))
    return fs.exists(target)


def _files(spark: SparkSession, folder: str) -> list[str]:
    fs, target = _hadoop_path(spark, folder)
    names = (status.getPath().getName() for status in fs.listStatus(target)) if fs.exists(target) else ()
    return [f"{folder}/{name}" for name in names if not name.startswith(("_", "."))]


def write_junk(spark: SparkSession, path: str, length: int = 10) -> None:
    """A file that is no Parquet file, for inputs that are broken on purpose."""
    fs, target = _hadoop_path(spark, path)
    stream = fs.create(target, True)
    stream.write(bytearray(b"x" * length))
    stream.close()


def drop_files(spark: SparkSession, folder: str) -> None:
    fs, target = _hadoop_path(spark, folder)
    fs.delete(target, True)


def spoil_files(spark: SparkSession, folder: str) -> None:
    """Overwrite every file of a folder with text."""
    for path in _files(spark, folder):
        write_junk(spark, path)


def cut_files(spark: SparkSession, folder: str) -> None:
    """Keep the first half of every file of a folder."""
    for path in _files(spark, folder):
        fs, target = _hadoop_path(spark, path)
        stream = fs.open(target)
        half = stream.readNBytes(fs.getFileStatus(target).getLen() // 2)
        stream.close()
        out = fs.create(target, True)
        out.write(half)
        out.close()


def drop_partitions(spark: SparkSession, path: str, days: Iterable[date]) -> None:
    """Delete `date=…` folders ahead of their rewrite."""
    for day in days:
        fs, target = _hadoop_path(spark, f"{path}/date={day.isoformat()}")
        if fs.exists(target):
            fs.delete(target, True)


def _versions(spark: SparkSession, path: str) -> dict[int, bool]:
    """Versions of a table that `replace_table` wrote: number, and whether it is whole."""
    fs, target = _hadoop_path(spark, path)
    if not fs.exists(target):
        return {}
    found = {}
    for status in fs.listStatus(target):
        name = status.getPath().getName()
        if name.startswith(VERSION):
            done = _hadoop_path(spark, f"{path}/{name}/_SUCCESS")[1]
            found[int(name.removeprefix(VERSION))] = fs.exists(done)
    return found


def _version_path(path: str, number: int) -> str:
    return f"{path}/{VERSION}{number:010d}"


def current_path(spark: SparkSession, path: str) -> str:
    """Where a table's rows are: its newest whole version, or the folder itself."""
    versions = _versions(spark, path)
    if not versions:
        return path
    whole = [number for number, done in versions.items() if done]
    return _version_path(path, max(whole)) if whole else f"{path}/_none"


# ---------------------------------------------------------------------------
# Writes
# ---------------------------------------------------------------------------
def append_rows(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def replace_partitions(rows: DataFrame, path: str, *partition_columns: str) -> None:
    """Replace exactly the partitions that occur in `rows`."""
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*(partition_columns or ("date",)))
        .parquet(path)
    )


def replace_table(rows: DataFrame, path: str) -> None:
    """Replace a whole table; readers see the old or the new one, never half and never none.

    Every write is a version of its own, and the newest with Spark's success marker is
    the table, so that nothing is renamed and a write that breaks at any step leaves the
    table as it was. A table may be rebuilt from itself. The version before stays for
    those who are reading it; older and broken ones go.
    """
    spark = rows.sparkSession
    path = path.rstrip("/")
    before = _versions(spark, path)
    rows.write.mode("errorifexists").parquet(_version_path(path, max(before, default=0) + 1))
    latest = max((number for number, done in before.items() if done), default=0)
    for number in before:
        if number != latest:
            fs, old = _hadoop_path(spark, _version_path(path, number))
            fs.delete(old, True)


def evenly_sized(rows: DataFrame, *columns: str) -> DataFrame:
    """Ask AQE for file-sized output tasks grouped by the partition columns.

    Small days are packed together and a day that holds most of the rows is split
    over many tasks, which a plain `repartition("date")` would not do.
    """
    return rows.hint("rebalance", *columns)


def keep(rows: DataFrame, path: str) -> DataFrame:
    """Store an intermediate result and return a scan of it."""
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


class Scratch:
    """Intermediate tables in the shared folder, removed when the block ends.

    A stored table survives lost executors, cuts the lineage, and is planned with
    its true size, which decides between a broadcast and a shuffle.
    """

    def __init__(self, spark: SparkSession, purpose: str) -> None:
        self._spark = spark
        self._root = shared_dir(spark, purpose)
        self._tables = 0

    def __enter__(self) -> Scratch:
        return self

    def keep(self, rows: DataFrame) -> DataFrame:
        self._tables += 1
        return keep(rows, f"{self._root}/{self._tables}")

    def __exit__(self, *failure) -> None:
        fs, root = _hadoop_path(self._spark, self._root)
        fs.delete(root, True)
