"""Where the tables live, and typed scans of them."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstrata import schemas as S
from ledgerstrata.operators import manifest as MF
from ledgerstrata.operators import reconcile as RC
from ledgerstrata.operators import runlog
from ledgerstrata.operators.quarantine import quarantine_all
from ledgerstrata.sources.buckets import BucketedIds
from ledgerstrata.sources.journal import Journal
from ledgerstrata.sources.tables import scan_addressed, scan_table, table_exists

_BRONZE = {"transactions": S.BRONZE_TRANSACTIONS, "accounts": S.BRONZE_ACCOUNTS}


def on_dates(rows: DataFrame, days: Iterable[date]) -> DataFrame:
    """Rows of the given dates; on a partitioned table a partition filter."""
    return rows.where(F.col("date").isin(sorted(days)))


@dataclass(frozen=True)
class Lake:
    """A folder of ledger tables and the folder of its source extracts.

    Transactions of both outcomes share one tree,
    `silver/transactions/disposition=accepted|rejected/date=…`, because one job
    writes them together.
    """

    spark: SparkSession
    root: str
    source: str
    #: Whether extracts may hold line breaks inside quotes; each file is then one task's.
    multi_line: bool = False
    #: Hash buckets of the ids of accepted transactions.
    id_buckets: int = 16

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def log_path(self) -> str:
        return self.path("pipeline", "run_log")

    @property
    def control_path(self) -> str:
        return self.path("pipeline", "control")

    def bronze(self, entity: str) -> DataFrame:
        return scan_table(self.spark, self.path("bronze", entity), _BRONZE[entity])

    def addressed_transactions(self) -> DataFrame:
        return scan_addressed(self.spark, self.path("bronze", "transactions"), S.BRONZE_TRANSACTIONS)

    def bronze_codes(self) -> DataFrame:
        return scan_table(self.spark, self.path("bronze", "transaction_codes"), S.BRONZE_CODES)

    def require_built(self, model: str, *parts: str) -> None:
        """An absent state table is an error once the log says that it was built."""
        if table_exists(self.spark, self.path(*parts)):
            return
        built = (F.col("model_name") == model) & (F.col("status") == S.SUCCESS)
        if not self.run_log().where(built).isEmpty():
            raise RuntimeError(f"table {'/'.join(parts)} is missing although {model} has built it")

    def silver_codes(self) -> DataFrame:
        return scan_table(self.spark, self.path("silver", "transaction_codes"), S.SILVER_CODES)

    def silver_accounts(self) -> DataFrame:
        return scan_table(self.spark, self.path("silver", "accounts"), S.SILVER_ACCOUNTS)

    def outcome_path(self, disposition: str) -> str:
        return self.path("silver", "transactions", f"disposition={disposition}")

    def silver_transactions(self) -> DataFrame:
        return scan_table(self.spark, self.outcome_path(S.ACCEPTED), S.SILVER_TRANSACTIONS)

    def versions(self, *tables: str) -> dict[str, dict[date, Row]]:
        """The versions of some tables by date: a few values per date, for decisions of a run."""
        rows = MF.versions_of(self.manifest(), *tables).collect()
        return {table: {r["date"]: r for r in rows if r["table_name"] == table} for table in tables}

    def promotion_gate(self) -> DataFrame:
        """Dates that Gold may read, from log and manifests; no row of a table is read.

        The latest attempt of the date succeeded, its Bronze rows are still those that were
        judged, and each of them is in Silver or in quarantine.
        """
        done = runlog.succeeded_dates(self.run_log(), "silver_transactions")
        kept = self.manifest()
        bronze = MF.versions(kept, "bronze_transactions")
        judged = MF.current(MF.versions(kept, "silver_transactions"), bronze)
        rejected = MF.versions(kept, "silver_quarantine")
        counted = RC.reconcile_counts(bronze, judged, rejected).join(judged.select("date"), "date", "left_semi")
        return RC.promotion_gate(counted).join(done, "date", "left_semi")

    def published_transactions(self) -> DataFrame:
        """Silver rows of the dates that pass the gate.

        A date a broken run left half written, or whose Bronze rows have changed since, is
        not read. The dates prune partitions when the query runs.
        """
        return RC.gated(self.silver_transactions(), self.promotion_gate())

    def rejected_transactions(self) -> DataFrame:
        renamed = {raw: name for name, raw in S.RAW_FIELDS.items()}
        stored = T.StructType(
            [
                T.StructField(S.RAW_FIELDS.get(f.name, f.name), f.dataType)
                for f in S.QUARANTINE_TRANSACTIONS.fields
            ]
        )
        rows = scan_table(self.spark, self.outcome_path(S.REJECTED), stored)
        return rows.withColumnsRenamed(renamed)

    def rejected_accounts(self) -> DataFrame:
        return scan_table(self.spark, self.path("silver", "accounts_rejected"), S.QUARANTINE_ACCOUNTS)

    def quarantine(self) -> DataFrame:
        """All rejects of both entities; typed and empty while there are none."""
        return quarantine_all(self.rejected_transactions(), self.rejected_accounts())

    def gold_daily(self) -> DataFrame:
        return scan_table(self.spark, self.path("gold", "daily_summary"), S.GOLD_DAILY)

    def gold_weekly(self) -> DataFrame:
        return scan_table(self.spark, self.path("gold", "weekly_account_summary"), S.GOLD_WEEKLY)

    def log_journal(self) -> Journal:
        return runlog.journal(self.spark, self.log_path)

    def run_log(self) -> DataFrame:
        return self.log_journal().rows()

    def manifest_journal(self) -> Journal:
        return Journal(self.spark, self.path("pipeline", "manifest"), S.MANIFEST, "recorded_at")

    def manifest(self) -> DataFrame:
        """What each write left, by table and date; see `operators.manifest`."""
        return self.manifest_journal().rows()

    def accepted_ids(self) -> BucketedIds:
        return BucketedIds(self.spark, self.path("silver", "transaction_ids"), self.id_buckets)

    def daily_partials(self) -> DataFrame:
        return scan_table(self.spark, self.path("gold", "daily_partials"), S.DAILY_PARTIALS)

    def weekly_partials(self) -> DataFrame:
        return scan_table(self.spark, self.path("gold", "weekly_partials"), S.WEEKLY_PARTIALS)

    def control(self) -> DataFrame:
        return scan_table(self.spark, self.control_path, S.CONTROL)
