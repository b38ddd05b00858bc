"""Accepted transaction ids in hash buckets, so that a look-up does not shuffle the history.

The table is a bucketed Parquet table of the session catalog over a folder of the lake;
its description is made anew in each session. Rows are only ever appended: each carries
the time of the judgement that accepted it, and judgements that no longer hold are left
out by a join with the few that do. `compact` writes the table anew without them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstrata import schemas as S
from ledgerstrata.sources.tables import _hadoop_path, _version_path, _versions

#: Files a bucket may gather before `compact` folds them.
MOST_FILES = 32


class BucketedIds:
    """Ids below `path`, in `buckets` hash buckets.

    One task writes and one task reads a bucket, so choose their number for buckets of
    some hundred megabytes. Another number is another table, filled from Silver.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int) -> None:
        self._spark, self._buckets = spark, buckets
        self._path = f"{path.rstrip('/')}/buckets={buckets}"

    def exists(self) -> bool:
        return bool(self._whole())

    def append(self, ids: DataFrame) -> None:
        """Add (transaction_id, date, judged_at); nothing is replaced."""
        versions = self._whole()
        if versions:
            table = self._table(versions[-1])
            self._dealt(ids).write.insertInto(table)
            self._spark.catalog.refreshTable(table)
        else:
            self._write(ids)

    def rows(self) -> DataFrame:
        versions = self._whole()
        if not versions:
            return self._spark.createDataFrame([], S.ACCEPTED_IDS)
        table = self._table(versions[-1])
        self._spark.catalog.refreshTable(table)
        return self._spark.table(table)

    def valid(self, judgements: DataFrame) -> DataFrame:
        """Ids of the judgements (date, judged_at), a table as small as the calendar."""
        return self.rows().join(F.broadcast(judgements), ["date", "judged_at"], "left_semi")

    def compact(self, judgements: Callable[[], DataFrame], most: int = MOST_FILES) -> bool:
        """Write the valid ids anew, one file a bucket, once there are many files."""
        versions = self._whole()
        if not versions:
            return False
        fs, folder = _hadoop_path(self._spark, _version_path(self._path, versions[-1]))
        files = sum(status.getPath().getName().startswith("part-") for status in fs.listStatus(folder))
        if files <= most * self._buckets:
            return False
        self._write(self.valid(judgements()))
        for number in versions[:-1]:
            fs, old = _hadoop_path(self._spark, _version_path(self._path, number))
            fs.delete(old, True)
        return True

    def _whole(self) -> list[int]:
        """Versions that were written to the end, oldest first."""
        return sorted(number for number, done in _versions(self._spark, self._path).items() if done)

    def _dealt(self, ids: DataFrame) -> DataFrame:
        """One task a bucket: Spark deals rows to tasks and to buckets by the same hash."""
        return ids.select(*S.ACCEPTED_IDS.names).repartition(self._buckets, "transaction_id")

    def _write(self, ids: DataFrame) -> None:
        """A new version; Spark's success marker says that all its buckets are there."""
        number = max(_versions(self._spark, self._path), default=0) + 1
        self._spark.sql(f"DROP TABLE IF EXISTS {self._name(number)}")
        (
            self._dealt(ids)
            .write.format("parquet")
            .bucketBy(self._buckets, "transaction_id")
            .option("path", _version_path(self._path, number))
            .saveAsTable(self._name(number))
        )

    def _name(self, number: int) -> str:
        return f"ledgerstrata_ids_{hashlib.md5(self._path.encode()).hexdigest()}_{number}"

    def _table(self, number: int) -> str:
        """The catalog's name of a version, described to this session if it does not know it."""
        table = self._name(number)
        if not self._spark.catalog.tableExists(table):
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.ACCEPTED_IDS.fields)
            location = _version_path(self._path, number).replace("'", "\\'")
            self._spark.sql(
                f"CREATE TABLE {table} ({columns}) USING parquet"
                f" CLUSTERED BY (transaction_id) INTO {self._buckets} BUCKETS LOCATION '{location}'"
            )
        return table
