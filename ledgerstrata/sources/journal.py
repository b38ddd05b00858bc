"""Append-only journals of small state rows, such as the run log.

Every append is a file of its own below `entries/month=YYYY-MM`. A month with many
files is compacted: one file holds all its rows and the names of the entries they
come from, so that an entry counts once wherever it is met. An entry that cannot be
read is left out and reported; it does not stop the others from being read.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstrata.sources.tables import _hadoop_path, _versions, current_path, is_missing_path, replace_table

#: Entries a month may gather before `compact` folds them.
MOST_ENTRIES = 24
_ENTRY = "_entry"


class Journal:
    """A folder of entries; `stamp` names the timestamp column whose month they go by."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, stamp: str) -> None:
        self._spark, self._path, self._schema, self._stamp = spark, path.rstrip("/"), schema, stamp

    def append(self, rows: DataFrame) -> None:
        """One file for each month in `rows`."""
        month = F.date_format(self._stamp, "yyyy-MM")
        (
            rows.select(*self._schema.names, month.alias("month"))
            .coalesce(1)
            .write.mode("append")
            .partitionBy("month")
            .parquet(f"{self._path}/entries")
        )

    def rows(self) -> DataFrame:
        """All rows of all readable entries; typed and empty while there are none."""
        entries, folded = self._entries("*"), self._folded(self._months("compacted"))
        if folded is None:
            return entries.drop(_ENTRY)
        fresh = entries.join(folded.select(_ENTRY).distinct(), _ENTRY, "left_anti")
        return folded.unionByName(fresh).drop(_ENTRY)

    def broken(self) -> DataFrame:
        """Names of files in the folder that give no row."""
        try:
            files = (
                self._spark.read.format("binaryFile").option("recursiveFileLookup", True).load(self._path)
            )
        except AnalysisException as error:
            if is_missing_path(error):
                return self._spark.createDataFrame([], "file string")
            raise
        named = files.where(~F.col("path").contains("/compacted/month=")).select(
            F.element_at(F.split("path", "/"), -1).alias("file")
        )
        read = self._entries("*").select(F.col(_ENTRY).alias("file")).distinct()
        return named.join(read, "file", "left_anti")

    def compact(self, most: int = MOST_ENTRIES) -> list[str]:
        """Fold every month with more than `most` open entries; returns these months.

        The entries a fold has taken in are deleted by the fold after it: until then they
        are there for those who listed them, and are not counted twice.
        """
        done = []
        for month in self._months("entries"):
            names = set(self._names(f"{self._path}/entries/month={month}"))
            before = self._folded([month])
            taken = set() if before is None else {r[0] for r in before.select(_ENTRY).distinct().collect()}
            if len(names - taken) <= most:
                continue
            fresh = self._entries(month)
            if before is not None:
                fresh = before.unionByName(fresh.where(~F.col(_ENTRY).isin(sorted(taken & names))))
            replace_table(fresh.coalesce(1), f"{self._path}/compacted/month={month}")
            for name in taken & names:
                fs, old = _hadoop_path(self._spark, f"{self._path}/entries/month={month}/{name}")
                fs.delete(old, False)
            done.append(month)
        return done

    def _entries(self, month: str) -> DataFrame:
        reader = self._spark.read.schema(self._schema).option("ignoreCorruptFiles", True)
        try:
            rows = reader.parquet(f"{self._path}/entries/month={month}")
        except AnalysisException as error:
            if not is_missing_path(error):
                raise
            rows = self._spark.createDataFrame([], self._schema)
            return rows.withColumn(_ENTRY, F.lit(None).cast("string"))
        return rows.select(*self._schema.names, F.col("_metadata.file_name").alias(_ENTRY))

    def _folded(self, months: list[str]) -> DataFrame | None:
        paths = [current_path(self._spark, f"{self._path}/compacted/month={m}") for m in months]
        whole = [path for path in paths if "/version-" in path]
        if not whole:
            return None
        schema = T.StructType([*self._schema.fields, T.StructField(_ENTRY, T.StringType())])
        return self._spark.read.schema(schema).parquet(*whole)

    def _months(self, part: str) -> list[str]:
        names = self._names(f"{self._path}/{part}")
        return sorted(n.removeprefix("month=") for n in names if n.startswith("month="))

    def _names(self, path: str) -> list[str]:
        fs, folder = _hadoop_path(self._spark, path)
        if not fs.exists(folder):
            return []
        names = (status.getPath().getName() for status in fs.listStatus(folder))
        return [name for name in names if not name.startswith(("_", "."))]
