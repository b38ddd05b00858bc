"""Every operator as a query over the test tables.

Checks run on inputs that break them on purpose, so that their counts say
something; the tests run the same checks on a clean lake and expect zero.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerstrata import schemas as S
from ledgerstrata.functions import scalars
from ledgerstrata.operators import accounts as AC
from ledgerstrata.operators import bronze as BR
from ledgerstrata.operators import checks as CK
from ledgerstrata.operators import codes as CD
from ledgerstrata.operators import gold as GD
from ledgerstrata.operators import manifest as MF
from ledgerstrata.operators import quarantine as QU
from ledgerstrata.operators import reconcile as RC
from ledgerstrata.operators import runlog as RL
from ledgerstrata.operators import transactions as TX
from ledgerstrata.plans import jobs
from ledgerstrata.plans.lake import Lake
from ledgerstrata.sources import adapters as A
from ledgerstrata.sources import extracts as EX
from ledgerstrata.sources import tables as TB
from ledgerstrata.sources.buckets import BucketedIds
from ledgerstrata.sources.journal import Journal

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Reports of the demonstration inputs.
STALE_DAY = date(2024, 1, 20)
LATE_DAY = date(2024, 1, 11)


class Ledger:
    """Inputs and derived tables of one adapter, built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = TB.configure(spark)
        self.sf_dir = sf_dir

    @cached_property
    def codes(self) -> DataFrame:
        return A.standard_codes(self.spark)

    @cached_property
    def classified(self) -> DataFrame:
        return self.judge(self.transactions)

    def keep(self, rows: DataFrame) -> DataFrame:
        return TB.keep(rows, TB.shared_dir(self.spark, "kept"))

    def judge(self, transactions: DataFrame, before: DataFrame | None = None) -> DataFrame:
        return TX.classify_transactions(
            transactions, self.codes, self.keep(self.known), before, self.order, self.keep
        )

    def store(self) -> Ledger:
        """Keep the classification as a table, for queries that use it repeatedly.

        `silver`, `rejects` and Gold then scan one stored result instead of each
        judging the transactions anew.
        """
        if "stored" not in self.__dict__:
            self.__dict__["classified"] = self.keep(self.classified)
            self.__dict__["stored"] = True
        return self

    @cached_property
    def known(self) -> DataFrame:
        return AC.first_sightings(self.passing)

    @cached_property
    def passing(self) -> DataFrame:
        return AC.passing_accounts(AC.classify_accounts(self.accounts))

    @cached_property
    def snapshot(self) -> DataFrame:
        return AC.silver_accounts(self.passing, A.RUN_ID, A.RUN_TIME)

    @cached_property
    def silver(self) -> DataFrame:
        return TX.promote_transactions(self.classified, A.RUN_ID, A.RUN_TIME)

    @cached_property
    def rejects(self) -> DataFrame:
        return TX.quarantine_transactions(self.classified, A.RUN_ID, A.RUN_TIME)

    @cached_property
    def daily(self) -> DataFrame:
        return GD.daily_totals(self.silver, self.codes)

    @cached_property
    def weekly(self) -> DataFrame:
        return GD.gold_weekly_account_summary(
            self.silver, self.codes, self.snapshot, A.RUN_ID, A.RUN_TIME
        ).drop("_computed_at")


class Events(Ledger):
    order = ("seq",)

    @cached_property
    def transactions(self) -> DataFrame:
        return A.event_transactions(self.spark, self.sf_dir)

    @cached_property
    def accounts(self) -> DataFrame:
        return A.customer_accounts(self.spark, self.sf_dir)

    @cached_property
    def full_accounts(self) -> DataFrame:
        """Deltas with missing fields and repeated accounts, classified."""
        return AC.classify_accounts(A.customer_accounts(self.spark, self.sf_dir, full=True))

    @cached_property
    def full_rejects(self) -> DataFrame:
        return QU.quarantine_accounts(self.full_accounts, A.RUN_ID, A.RUN_TIME)

    @cached_property
    def log(self) -> DataFrame:
        return A.event_run_log(self.spark, self.sf_dir)


class Lineitems(Ledger):
    order = A.LINEITEM_ORDER

    @cached_property
    def transactions(self) -> DataFrame:
        return A.lineitem_transactions(self.spark, self.sf_dir)

    @cached_property
    def accounts(self) -> DataFrame:
        return A.supplier_accounts(self.spark, self.sf_dir)


def query(*, on: type[Ledger] = Events, name: str | None = None):
    """Register a function of a ledger under its own name."""

    def register(build: Callable[[Ledger], DataFrame]):
        QUERIES[name or build.__name__] = lambda spark, sf_dir: build(on(spark, sf_dir))
        return build

    return register


# ---------------------------------------------------------------------------
# Extract files for the queries that read or load CSV
# ---------------------------------------------------------------------------
def dump_extracts(rows: DataFrame, entity: str, columns: list[str], folder: str) -> None:
    """Write rows as dated extracts, one folder of part files per day."""
    day = F.concat(F.lit(f"{entity}_"), F.col("date").cast("string"), F.lit(".csv"))
    # The CSV writer spells small decimals with an exponent (0E-7); a cast spells them in full.
    texts = [F.col(c).cast("string").alias(c) for c in columns]
    (
        TB.evenly_sized(rows.select(*texts, day.alias("extract")), "extract")
        .write.mode("append")
        .partitionBy("extract")
        .option("header", True)
        .option("escape", '"')
        .csv(folder)
    )


def _source_folder(ledger: Events, full: bool = False) -> str:
    folder = TB.shared_dir(ledger.spark, "extracts")
    dump_extracts(ledger.transactions, "transactions", S.TRANSACTION_SOURCE.names, folder)
    accounts = A.customer_accounts(ledger.spark, ledger.sf_dir, full)
    dump_extracts(accounts, "accounts", S.ACCOUNT_SOURCE.names, folder)
    codes = A.event_codes(ledger.spark, ledger.sf_dir).select(*S.CODE_SOURCE.names)
    codes.coalesce(1).write.option("header", True).csv(f"{folder}/transaction_codes.csv")
    return folder


def _lake(ledger: Events, full: bool = False) -> Lake:
    return Lake(ledger.spark, TB.shared_dir(ledger.spark, "lake"), _source_folder(ledger, full))


def _event_days(ledger: Events) -> list[date]:
    first, last = ledger.transactions.select(F.min("date"), F.max("date")).first()
    days = EX.calendar(ledger.spark, first, last).collect()
    return [row["date"] for row in days]


def _bronze_run(ledger: Events, full: bool = False) -> jobs.Run:
    return jobs.Run(_lake(ledger, full), A.RUN_ID, S.HISTORICAL, A.RUN_TIME)


# ---------------------------------------------------------------------------
# Sources and sinks
# ---------------------------------------------------------------------------
@query()
def bronze_transactions(e: Events) -> DataFrame:
    run = _bronze_run(e)
    jobs.load_bronze(run, "transactions", _event_days(e))
    return run.lake.bronze("transactions").drop("_ingested_at")


@query()
def bronze_accounts(e: Events) -> DataFrame:
    run = _bronze_run(e, full=True)
    jobs.load_bronze(run, "accounts", _event_days(e))
    return run.lake.bronze("accounts").drop("_ingested_at")


@query()
def bronze_transaction_codes(e: Events) -> DataFrame:
    run = _bronze_run(e)
    jobs.load_codes(run)
    return run.lake.bronze_codes().drop("_ingested_at")


@query()
def source_counts(e: Events) -> DataFrame:
    folder = TB.shared_dir(e.spark, "extracts")
    dump_extracts(e.transactions, "transactions", S.TRANSACTION_SOURCE.names, folder)
    return EX.source_counts(EX.scan_entity(e.spark, folder, "transactions", S.TRANSACTION_SOURCE))


def _partitioned(e: Events) -> tuple[str, DataFrame]:
    """Silver rows written by date, and a scan of the whole tree."""
    path = TB.shared_dir(e.spark, "silver")
    TB.replace_partitions(TB.evenly_sized(e.silver, "date"), path)
    return path, TB.scan_table(e.spark, path, S.SILVER_TRANSACTIONS)


@query()
def scan_partitioned(e: Events) -> DataFrame:
    _, rows = _partitioned(e)
    return rows.drop("_bronze_ingested_at", "_promoted_at")


@query()
def scan_one_partition(e: Events) -> DataFrame:
    path, _ = _partitioned(e)
    rows = TB.scan_partition(e.spark, path, S.SILVER_TRANSACTIONS, STALE_DAY)
    return rows.drop("_bronze_ingested_at", "_promoted_at")


@query()
def scan_absent(e: Events) -> DataFrame:
    """Rows per day of a table that was never written, next to those of one that was."""
    path, rows = _partitioned(e)
    absent = TB.scan_table(e.spark, f"{path}-absent", S.SILVER_TRANSACTIONS)
    stored = BR.rows_per_date(rows, "stored_rows")
    return stored.join(BR.rows_per_date(absent, "absent_rows"), "date", "left").fillna(0, "absent_rows")


def _places(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows with their place in the order in which a table holds them."""
    at = Window.orderBy(*columns)
    return rows.withColumn("place", F.row_number().over(at).cast("long"))


@query()
def gold_daily_written_order(e: Events) -> DataFrame:
    """The dates of the daily table in the order of its files and rows."""
    path = TB.shared_dir(e.spark, "gold")
    TB.replace_table(e.daily.orderBy("transaction_date"), path)
    rows = TB.scan_table(e.spark, path, e.daily.schema)
    found = rows.select("transaction_date", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    return _places(found, "file", "row").select("transaction_date", "place")


@query()
def run_log_order(e: Events) -> DataFrame:
    """The attempts in the order in which the log is read."""
    path = TB.shared_dir(e.spark, "run-log")
    for layer in ("GOLD", "SILVER", "BRONZE"):
        RL.append_run_log(e.log.where(F.col("layer") == layer), path)
    read = RL.read_run_log(e.spark, path).withColumn("_at", F.monotonically_increasing_id())
    return _places(read, "_at").select("run_id", "model_name", "place")


@query()
def missing_dates(e: Events) -> DataFrame:
    """Days around the event period for which nothing arrived."""
    period = e.transactions.select(F.min("date").alias("a"), F.max("date").alias("b"))
    days = F.sequence(F.date_sub("a", 3), F.date_add("b", 2))
    return EX.missing_dates(period.select(F.explode(days).alias("date")), e.transactions)


@query()
def bronze_load_plan(e: Events) -> DataFrame:
    """What a load would do to a Bronze table with five kinds of damage.

    Of the days of the month, the 2nd was never loaded, the 3rd is gone, a file of the 5th
    is cut, one of the 7th is no Parquet file, and the extract of the 9th has grown since.
    """
    run = _bronze_run(e)
    lake, days = run.lake, _event_days(e)
    short = f"{lake.source}-short"
    rows = e.transactions.where((F.dayofmonth("date") != 9) | (F.col("seq") % 10 > 0))
    dump_extracts(rows, "transactions", S.TRANSACTION_SOURCE.names, short)
    earlier = jobs.Run(Lake(e.spark, lake.root, short), A.RUN_ID, S.HISTORICAL, A.RUN_TIME)
    jobs.load_bronze(earlier, "transactions", [day for day in days if day.day != 2])
    harm = {3: TB.drop_files, 5: TB.cut_files, 7: TB.spoil_files}
    for day in days:
        if day.day in harm:
            harm[day.day](e.spark, f"{lake.path('bronze', 'transactions')}/date={day}")
    source = EX.scan_entity(e.spark, lake.source, "transactions", S.TRANSACTION_SOURCE)
    found = jobs.bronze_rows_found(lake, "transactions", days)
    return BR.load_plan(BR.rows_per_date(source, "source_rows"), found)


# ---------------------------------------------------------------------------
# Silver
# ---------------------------------------------------------------------------
_VERDICT = ("transaction_id", "account_id", "date", "amount", "transaction_code", "channel")


@query(name="silver_transaction_codes")
def _silver_transaction_codes(e: Events) -> DataFrame:
    codes = CD.silver_transaction_codes(A.event_codes(e.spark, e.sf_dir), A.RUN_ID)
    return codes.drop("_bronze_ingested_at")


@query()
def accounts_classified(e: Events) -> DataFrame:
    return e.full_accounts.drop("_ingested_at")


@query()
def silver_accounts(e: Events) -> DataFrame:
    table = AC.silver_accounts(AC.passing_accounts(e.full_accounts), A.RUN_ID, A.RUN_TIME)
    return table.drop("_bronze_ingested_at", "_record_valid_from")


@query()
def accounts_upsert(e: Events) -> DataFrame:
    """The snapshot of the first ten days, updated with the later deltas."""
    passing = AC.passing_accounts(e.full_accounts)
    early = AC.newest_per_account(passing.where(F.col("date") <= date(2024, 1, 10)))
    late = AC.newest_per_account(passing.where(F.col("date") > date(2024, 1, 10)))
    return AC.upsert_accounts(early, late).select("account_id", "current_balance", "date")


@query()
def transactions_classified(e: Events) -> DataFrame:
    return e.classified.select("seq", *_VERDICT, "_is_resolvable", "_rejection_reason")


@query()
def transactions_classified_rerun(e: Events) -> DataFrame:
    """The dates after the 20th, judged against the ids taken before, held in hash buckets.

    A judgement of the 20th that no longer holds left ids too; they must not count.
    """
    late = F.col("date") > F.lit(STALE_DAY)
    before = e.judge(e.transactions.where(~late)).where(F.col("_rejection_reason").isNull())
    table = BucketedIds(e.spark, TB.shared_dir(e.spark, "ids"), 8)
    now, old = F.lit(A.RUN_TIME).cast("timestamp"), F.lit(A.RUN_TIME - timedelta(days=1)).cast("timestamp")
    stale = e.transactions.where(late).select("transaction_id", F.lit(STALE_DAY).alias("date"))
    table.append(stale.where(F.col("transaction_id").isNotNull()).withColumn("judged_at", old))
    table.append(before.withColumn("judged_at", now))
    in_force = before.select("date").distinct().withColumn("judged_at", now)
    again = e.judge(e.transactions.where(late), table.valid(in_force))
    return again.select("seq", *_VERDICT, "_is_resolvable", "_rejection_reason")


@query()
def silver_transactions(e: Events) -> DataFrame:
    return e.silver.drop("_bronze_ingested_at", "_promoted_at")


@query()
def quarantine_transactions(e: Events) -> DataFrame:
    return e.rejects.drop("_rejected_at")


@query()
def quarantine_accounts(e: Events) -> DataFrame:
    return e.full_rejects.drop("_rejected_at")


@query()
def quarantine_all(e: Events) -> DataFrame:
    return QU.quarantine_all(e.rejects, e.full_rejects).drop("_rejected_at")


@query()
def rejection_summary(e: Events) -> DataFrame:
    return QU.rejection_summary(e.rejects)


@query(name="rejection_summary_accounts")
def _rejection_summary_accounts(e: Events) -> DataFrame:
    return QU.rejection_summary(e.full_rejects)


# ---------------------------------------------------------------------------
# Gold
# ---------------------------------------------------------------------------
@query()
def gold_daily_summary(e: Events) -> DataFrame:
    """The daily table with its nested entries spread over columns."""
    table = GD.gold_daily_summary(e.silver, e.codes, A.RUN_ID, A.RUN_TIME)
    cells = []
    for kind in S.TRANSACTION_TYPES:
        for part in ("count", "sum"):
            cell = F.col(f"transactions_by_type.{kind}.{part}")
            cells.append(cell.alias(f"{kind.lower()}_{part}"))
    return table.select("*", *cells).drop("transactions_by_type", "_computed_at")


@query()
def gold_weekly_account_summary(e: Events) -> DataFrame:
    return e.weekly


@query()
def gold_daily_from_partials(e: Events) -> DataFrame:
    """Daily figures folded from partials that were written by processing date."""
    path = TB.shared_dir(e.spark, "partials")
    TB.replace_partitions(TB.evenly_sized(GD.daily_partials(e.silver, "date"), "date"), path)
    return GD.fold_daily(TB.scan_table(e.spark, path, S.DAILY_PARTIALS), e.codes)


@query()
def gold_weekly_from_partials(e: Events) -> DataFrame:
    path = TB.shared_dir(e.spark, "partials")
    TB.replace_partitions(TB.evenly_sized(GD.weekly_partials(e.silver, "date"), "date"), path)
    return GD.fold_weekly(TB.scan_table(e.spark, path, S.WEEKLY_PARTIALS), e.codes)


@query(on=Lineitems)
def transactions_classified_lineitem(ledger: Lineitems) -> DataFrame:
    return ledger.classified.select(*_VERDICT, "_is_resolvable", "_rejection_reason")


@query(on=Lineitems)
def rejection_summary_lineitem(ledger: Lineitems) -> DataFrame:
    return QU.rejection_summary(ledger.rejects)


@query(on=Lineitems)
def gold_daily_summary_lineitem(ledger: Lineitems) -> DataFrame:
    return ledger.daily


@query(on=Lineitems)
def gold_weekly_account_summary_lineitem(ledger: Lineitems) -> DataFrame:
    return ledger.weekly


# ---------------------------------------------------------------------------
# Reconciliation and run comparison
# ---------------------------------------------------------------------------
@query()
def reconciliation(e: Events) -> DataFrame:
    e.store()
    return RC.reconcile(e.transactions, e.silver, e.rejects)


@query()
def reconciliation_lost_partition(e: Events) -> DataFrame:
    """Counts from the footers of written tables, after Silver has lost a day's files."""
    root = TB.shared_dir(e.spark, "layers")
    bronze = e.transactions.select(*S.TRANSACTION_SOURCE.names, "date")
    TB.replace_partitions(TB.evenly_sized(bronze, "date"), f"{root}/bronze")
    outcome = TX.split_by_disposition(e.classified, A.RUN_ID, A.RUN_TIME)
    TB.replace_partitions(
        TB.evenly_sized(outcome, "disposition", "date"), f"{root}/silver", "disposition", "date"
    )
    TB.drop_files(e.spark, f"{root}/silver/disposition={S.ACCEPTED}/date={STALE_DAY}")
    layers = ["bronze", f"silver/disposition={S.ACCEPTED}", f"silver/disposition={S.REJECTED}"]
    return RC.reconcile(*(TB.scan_table(e.spark, f"{root}/{layer}", S.DAYS) for layer in layers))


def _leaky_reconciliation(e: Events) -> DataFrame:
    """Silver and quarantine after the rejected channels were lost."""
    e.store()
    kept = e.rejects.where(F.col("_rejection_reason") != S.INVALID_CHANNEL)
    return RC.reconcile(e.transactions, e.silver, kept)


@query()
def reconciliation_total(e: Events) -> DataFrame:
    return RC.reconcile_total(_leaky_reconciliation(e))


@query()
def promotion_gate(e: Events) -> DataFrame:
    """Dates for Gold when the duplicates rejected on odd days went missing."""
    e.store()
    odd = F.dayofmonth("date") % 2 == 1
    lost = (F.col("_rejection_reason") == S.DUPLICATE_TRANSACTION_ID) & odd
    return RC.promotion_gate(RC.reconcile(e.transactions, e.silver, e.rejects.where(~lost)))


@query()
def promotion_gate_daily(e: Events) -> DataFrame:
    """Daily Gold over the gated dates only."""
    e.store()
    odd = F.dayofmonth("date") % 2 == 1
    lost = (F.col("_rejection_reason") == S.DUPLICATE_TRANSACTION_ID) & odd
    gate = RC.promotion_gate(RC.reconcile(e.transactions, e.silver, e.rejects.where(~lost)))
    return GD.daily_totals(RC.gated(e.silver, gate), e.codes)


def _metrics(e: Events, silver: DataFrame) -> DataFrame:
    """Metrics with Gold computed from the given Silver rows."""
    e.store()
    return RC.layer_metrics(
        e.transactions,
        e.accounts,
        A.event_codes(e.spark, e.sf_dir),
        e.silver,
        e.snapshot,
        e.rejects,
        GD.daily_totals(silver, e.codes),
        GD.weekly_totals(silver, e.codes),
        RL.watermark_from_log(e.log),
    )


@query()
def layer_metrics(e: Events) -> DataFrame:
    return _metrics(e, e.silver)


def _differing_metrics(e: Events) -> DataFrame:
    """A run against one whose Gold saw the dates up to the 20th only."""
    stale = e.silver.where(F.col("transaction_date") <= F.lit(STALE_DAY))
    return RC.compare_metrics(_metrics(e, e.silver), _metrics(e, stale))


@query()
def idempotency_diff(e: Events) -> DataFrame:
    return _differing_metrics(e)


@query()
def idempotency_content_diff(e: Events) -> DataFrame:
    """Two runs that differ in one cent of one row, told apart by their manifests alone."""
    e.store()
    content = [c for c in S.SILVER_TRANSACTIONS.names if c not in S.STAMPS]
    first = e.silver.select(F.min("transaction_id")).first()[0]
    cent = F.when(F.col("transaction_id") == first, F.lit("0.01").cast(S.AMOUNT)).otherwise(0)
    altered = e.silver.withColumn("amount", (F.col("amount") + cent).cast(S.AMOUNT))
    days = _event_days(e)
    manifests = []
    for silver in (e.silver, altered):
        kept = Journal(e.spark, TB.shared_dir(e.spark, "manifest"), S.MANIFEST, "recorded_at")
        tables = {"silver_transactions": (silver, content), "silver_quarantine": (e.rejects, S.TRANSACTION_SOURCE.names)}
        for name, (rows, columns) in tables.items():
            counted = MF.by_date(rows, columns).collect()
            entries = MF.entries(counted, name, days, A.RUN_ID, A.RUN_TIME)
            kept.append(TB.small_table(e.spark, entries, S.MANIFEST))
        manifests.append(kept.rows())
    return MF.compare(*manifests)


# ---------------------------------------------------------------------------
# Run log and watermark
# ---------------------------------------------------------------------------
def _plain_times(log: DataFrame) -> DataFrame:
    """Times as seconds, free of any session time zone."""
    return log.withColumns(
        {name: F.unix_seconds(name) for name in ("started_at", "completed_at")}
    )


@query()
def run_log(e: Events) -> DataFrame:
    path = TB.shared_dir(e.spark, "run-log")
    RL.append_run_log(e.log.where(F.col("layer") == "BRONZE"), path)
    RL.append_run_log(e.log.where(F.col("layer") != "BRONZE"), path)
    return _plain_times(RL.read_run_log(e.spark, path))


@query()
def run_log_compacted(e: Events) -> DataFrame:
    """The log in many appends, folded twice on the way, with a broken file in its folder."""
    path = TB.shared_dir(e.spark, "run-log")
    kept = RL.journal(e.spark, path)
    for part in range(6):
        RL.append_run_log(e.log.where(F.dayofmonth("processing_date") % 6 == part), path)
        if part in (2, 4):
            kept.compact(most=1)
    TB.write_junk(e.spark, f"{path}/entries/month=2024-01/part-junk.parquet")
    TB.write_junk(e.spark, f"{path}/junk.parquet")
    return _plain_times(kept.rows())


@query()
def run_log_latest(e: Events) -> DataFrame:
    return _plain_times(RL.latest_attempts(e.log)).drop("error_message")


@query()
def run_log_sanitized(e: Events) -> DataFrame:
    log = RL.sanitize_errors(e.log.where(F.col("error_message").isNotNull()))
    return log.select("run_id", "model_name", "error_message")


@query()
def accounts_ready(e: Events) -> DataFrame:
    return RL.accounts_ready(e.log)


@query()
def watermark(e: Events) -> DataFrame:
    """The mark the log allows, through the control table."""
    path = TB.shared_dir(e.spark, "control")
    mark = RL.watermark_from_log(e.log).first()["last_processed_date"]
    RL.write_watermark(e.spark, path, mark, A.RUN_ID, A.RUN_TIME)
    return TB.scan_table(e.spark, path, S.CONTROL).drop("updated_at")


@query()
def next_date(e: Events) -> DataFrame:
    return RL.next_date(RL.watermark_from_log(e.log))


@query()
def iso_days(e: Events) -> DataFrame:
    """Which texts count as full ISO dates: whole ones, cut ones, and ones with more behind."""
    day = F.col("date").cast("string")
    kind = F.col("seq") % 5
    text = (
        F.when(kind == 0, F.substring(day, 1, 4))
        .when(kind == 1, F.substring(day, 1, 7))
        .when(kind == 2, F.concat(day, F.lit("T00")))
        .when(kind == 3, F.regexp_replace(day, "-01-", "-13-"))
        .otherwise(day)
    )
    return e.transactions.select("seq", text.alias("text")).withColumn("is_day", scalars.is_iso_day(F.col("text")))


@query()
def scalar_functions(e: Events) -> DataFrame:
    day = F.col("transaction_date")
    return e.transactions.select(
        "seq",
        scalars.week_start(day).alias("week_start"),
        scalars.week_end(day).alias("week_end"),
        scalars.is_monday(day).alias("is_monday"),
        F.trim(F.concat(F.lit("  "), "channel", F.lit(" "))).alias("trimmed"),
        F.coalesce("account_id", F.lit("none")).alias("account_or_none"),
        F.abs("amount").alias("abs_amount"),
        scalars.gold_money(F.col("amount")).alias("gold_amount"),
        scalars.signed(F.col("amount"), F.when(F.col("channel") == "ONLINE", "DR")).alias("signed"),
        scalars.extract_date(F.col("_source_file")).alias("file_date"),
        scalars.scrub_error(F.concat(F.lit("lost /lake/"), "_source_file", F.lit(" again"))).alias("scrubbed"),
    )


# ---------------------------------------------------------------------------
# Whole runs
# ---------------------------------------------------------------------------
def _run_report(lake: Lake) -> DataFrame:
    """Per date: counts of every layer and the daily Gold figures."""
    counts = RC.reconcile(
        lake.bronze("transactions"), lake.silver_transactions(), lake.rejected_transactions()
    )
    gold = lake.gold_daily().select(
        F.col("transaction_date").alias("date"), "total_transactions", "total_signed_amount"
    )
    mark = lake.control().select(F.max("last_processed_date")).scalar()
    return counts.join(gold, "date", "left").withColumn("watermark", mark)


@query()
def historical_run(e: Events) -> DataFrame:
    lake = _lake(e)
    days = _event_days(e)
    jobs.run_historical(lake, days[0], days[-1], A.RUN_ID)
    return _run_report(lake)


@query()
def incremental_run(e: Events) -> DataFrame:
    """A historical run of all days but the last, which comes by an incremental run."""
    lake = _lake(e)
    days = _event_days(e)
    jobs.run_historical(lake, days[0], days[-2], A.RUN_ID)
    jobs.run_incremental(lake, A.RUN_ID)
    return _run_report(lake)


@query()
def regrown_extract_run(e: Events) -> DataFrame:
    """A published day whose extract grows: it is loaded and judged again, and Gold follows."""
    whole = _lake(e)
    short = f"{whole.source}-short"
    rows = e.transactions.where((F.col("date") != LATE_DAY) | (F.col("seq") % 10 > 0))
    dump_extracts(rows, "transactions", S.TRANSACTION_SOURCE.names, short)
    dump_extracts(e.accounts, "accounts", S.ACCOUNT_SOURCE.names, short)
    codes = A.event_codes(e.spark, e.sf_dir).select(*S.CODE_SOURCE.names)
    codes.coalesce(1).write.option("header", True).csv(f"{short}/transaction_codes.csv")
    days = _event_days(e)
    jobs.run_historical(Lake(e.spark, whole.root, short), days[0], days[-1], A.RUN_ID)
    jobs.run_historical(whole, days[0], days[-1], f"{A.RUN_ID}-2")
    return _run_report(whole)


# ---------------------------------------------------------------------------
# Checks, on inputs that break them
# ---------------------------------------------------------------------------
CHECKS: dict[str, Callable[[Events], DataFrame]] = {}


def check(build: Callable[[Events], DataFrame]):
    CHECKS[build.__name__] = build
    return query()(build)


def _unsigned(e: Events) -> DataFrame:
    """Unfiltered rows: unknown codes have no sign, unknown accounts no flag."""
    known = F.col("known_from") <= F.col("date")
    sign = F.when(F.col("_indicator") == S.DEBIT, 1).when(F.col("_indicator") == S.CREDIT, -1)
    rows = e.classified.join(
        e.known.withColumnRenamed("account_id", "_known_id"),
        F.col("account_id") == F.col("_known_id"),
        "left",
    )
    return rows.withColumns(
        {
            "_signed_amount": F.col("amount") * sign,
            "_is_resolvable": known,
            "_pipeline_run_id": F.when(F.col("account_id").isNotNull(), F.lit(A.RUN_ID)),
        }
    )


def _run_ids(rows: DataFrame) -> DataFrame:
    """Rows stamped with the first attempt's run id of their date."""
    name = F.concat(F.lit("run-"), F.col("date").cast("string"), F.lit("-1"))
    return rows.withColumn("_pipeline_run_id", name)


def _stale_silver(e: Events) -> DataFrame:
    return e.silver.where(F.col("transaction_date") <= F.lit(STALE_DAY))


def _generous_silver(e: Events) -> DataFrame:
    """Silver whose unresolvable rows were counted in as well."""
    return e.silver.withColumn("_is_resolvable", F.lit(True))


@check
def check_b01(e: Events) -> DataFrame:
    deduplicated = e.transactions.select("transaction_id", "date").distinct()
    return CK.b01(e.transactions, deduplicated)


@check
def check_b02(e: Events) -> DataFrame:
    return CK.b02(A.customer_accounts(e.spark, e.sf_dir, full=True), e.accounts)


@check
def check_b03(e: Events) -> DataFrame:
    types = A.read(e.spark, e.sf_dir, "events").select("event_type").distinct()
    return CK.b03(types, A.event_codes(e.spark, e.sf_dir))


@check
def check_b04(e: Events) -> DataFrame:
    stamped = F.when(F.col("account_status") == "ACTIVE", F.col("_pipeline_run_id"))
    accounts = e.accounts.withColumn("_pipeline_run_id", stamped)
    return CK.b04(_unsigned(e), accounts, A.event_codes(e.spark, e.sf_dir))


@check
def check_b05(e: Events) -> DataFrame:
    return CK.b05(e.transactions)


@check
def check_st01(e: Events) -> DataFrame:
    return CK.st01(e.transactions)


@check
def check_st02(e: Events) -> DataFrame:
    return CK.silver_row_checks(_unsigned(e), "ST-02")


@check
def check_st03(e: Events) -> DataFrame:
    return CK.silver_row_checks(_unsigned(e), "ST-03")


@check
def check_st04(e: Events) -> DataFrame:
    return CK.st04(_leaky_reconciliation(e))


@check
def check_st05(e: Events) -> DataFrame:
    return CK.st05(e.classified)


@check
def check_st06(e: Events) -> DataFrame:
    """Quarantine that took the unresolvable rows in although Silver has them."""
    e.store()
    reason = F.when(~F.col("_is_resolvable"), F.lit("UNRESOLVABLE"))
    wrong = e.classified.withColumn("_rejection_reason", F.coalesce("_rejection_reason", reason))
    rejects = TX.quarantine_transactions(wrong, A.RUN_ID, A.RUN_TIME)
    return CK.st06(e.silver, CK.amounts_alike(rejects), S.TRANSACTION_SOURCE.names)


@check
def check_st07(e: Events) -> DataFrame:
    return CK.st07(_run_ids(e.silver), e.log)


@check
def check_st08(e: Events) -> DataFrame:
    return CK.st08(e.transactions, e.codes)


@check
def check_st09(e: Events) -> DataFrame:
    return CK.st09(_leaky_reconciliation(e))


def _dirty_accounts(e: Events) -> DataFrame:
    """Unfiltered, repeated deltas; rejected ones carry no audit values."""
    good = F.col("_rejection_reason").isNull()
    return e.full_accounts.withColumns(
        {
            "_pipeline_run_id": F.when(good, F.col("_pipeline_run_id")),
            "_record_valid_from": F.when(F.col("account_status") == "ACTIVE", F.col("_ingested_at")),
        }
    )


@check
def check_sa01(e: Events) -> DataFrame:
    return CK.sa01(e.full_accounts)


@check
def check_sa02(e: Events) -> DataFrame:
    return CK.account_row_checks(_dirty_accounts(e), "SA-02")


@check
def check_sa03(e: Events) -> DataFrame:
    return CK.account_row_checks(_dirty_accounts(e), "SA-03")


@check
def check_sa04(e: Events) -> DataFrame:
    return CK.account_row_checks(e.full_accounts, "SA-04")


@check
def check_sa05(e: Events) -> DataFrame:
    return CK.account_reject_checks(e.full_accounts, "SA-05")


@check
def check_sa06(e: Events) -> DataFrame:
    return CK.account_reject_checks(e.classified, "SA-06")


@check
def check_g01(e: Events) -> DataFrame:
    e.store()
    return CK.g01(e.silver, GD.daily_totals(_stale_silver(e), e.codes))


@query()
def gold_spine_mismatch(e: Events) -> DataFrame:
    e.store()
    return CK.spine_mismatch(e.silver, GD.daily_totals(_stale_silver(e), e.codes))


@check
def check_g02(e: Events) -> DataFrame:
    e.store()
    wrong = GD.daily_totals(_generous_silver(e), e.codes)
    return CK.daily_totals_checks(e.silver, wrong, "G-02")


@check
def check_g03(e: Events) -> DataFrame:
    e.store()
    wrong = GD.daily_totals(_generous_silver(e), e.codes)
    return CK.daily_totals_checks(e.silver, wrong, "G-03")


@check
def check_g04(e: Events) -> DataFrame:
    """Gold from yesterday's Silver against today's."""
    e.store()
    stale = GD.weekly_totals(e.silver.where(F.col("channel") == "ONLINE"), e.codes)
    return CK.g04(e.silver, e.codes, stale)


def _shifted_weeks(e: Events) -> DataFrame:
    """Weeks cut at the transaction date instead of at Monday, ends unmoved."""
    day = F.col("transaction_date")
    return (
        e.silver.where(F.col("_is_resolvable"))
        .select(day.alias("week_start_date"), scalars.week_end(day).alias("week_end_date"), "account_id")
        .distinct()
    )


@check
def check_g05(e: Events) -> DataFrame:
    return CK.weekly_row_checks(_shifted_weeks(e), "G-05")


@check
def check_g06(e: Events) -> DataFrame:
    return CK.weekly_row_checks(_shifted_weeks(e), "G-06")


@check
def check_g07(e: Events) -> DataFrame:
    e.store()
    busy = F.when(F.col("total_transactions") > 100, F.lit(A.RUN_ID))
    bought = F.when(F.col("total_purchases") > 0, F.lit(A.RUN_ID))
    return CK.g07(
        e.daily.withColumn("_pipeline_run_id", busy),
        e.weekly.withColumn("_pipeline_run_id", bought),
    )


@check
def check_i01(e: Events) -> DataFrame:
    return CK.i01(_differing_metrics(e))


@check
def check_at01(e: Events) -> DataFrame:
    """The mark stands before the last date of the log, because of a failed day."""
    last = e.log.select(F.max("processing_date")).first()[0]
    return CK.at01(RL.watermark_from_log(e.log), last)


@check
def check_at02(e: Events) -> DataFrame:
    """Second attempts never loaded Bronze, so their run ids lead nowhere."""
    name = F.concat(F.lit("run-"), F.col("date").cast("string"), F.lit("-2"))
    codes = A.event_codes(e.spark, e.sf_dir)
    return CK.at02(_run_ids(e.transactions), e.accounts.withColumn("_pipeline_run_id", name), codes, e.log)


@check
def check_at03(e: Events) -> DataFrame:
    daily = _run_ids(e.daily.withColumnRenamed("transaction_date", "date"))
    return CK.at03(daily, e.weekly, e.log)


@check
def check_or01(e: Events) -> DataFrame:
    return CK.or01(e.transactions.select("date").distinct(), RL.accounts_ready(e.log))


@check
def check_tc01(e: Events) -> DataFrame:
    """Code rows per event type, where unknown types carry no indicator."""
    coded = e.transactions.select("transaction_code").distinct().join(
        e.codes.select("transaction_code", "debit_credit_indicator"), "transaction_code", "left"
    )
    return CK.indicator_values(coded)


def _declared(e: Events) -> DataFrame:
    e.store()
    unsigned = _unsigned(e)
    weekly = GD.weekly_totals(unsigned.withColumn("_is_resolvable", F.lit(True)), e.codes)
    return CK.declared_tests(
        {
            "silver_transaction_codes": e.transactions.select("transaction_code", "_pipeline_run_id"),
            "silver_accounts": _dirty_accounts(e),
            "silver_transactions": unsigned,
            "gold_daily_summary": e.silver,
            "gold_weekly_account_summary": weekly.withColumn(
                "_pipeline_run_id", F.when(F.col("total_purchases") > 0, F.lit(A.RUN_ID))
            ),
        }
    )


@query()
def check_declared(e: Events) -> DataFrame:
    """The sixteen declared column tests on unfiltered inputs."""
    return _declared(e)


@query()
def check_all(e: Events) -> DataFrame:
    """Every check in one report.

    The classification is stored once and read by all checks, and checks on rows
    of one table share a scan.
    """
    e.store()
    wrong = GD.daily_totals(_generous_silver(e), e.codes)
    folded = {
        ("check_st02", "check_st03"): CK.silver_row_checks(_unsigned(e)),
        ("check_sa02", "check_sa03"): CK.account_row_checks(_dirty_accounts(e), "SA-02", "SA-03"),
        ("check_g02", "check_g03"): CK.daily_totals_checks(e.silver, wrong),
        ("check_g05", "check_g06"): CK.weekly_row_checks(_shifted_weeks(e)),
    }
    covered = {name for names in folded for name in names}
    single = [build(e) for name, build in CHECKS.items() if name not in covered]
    return CK.combine([*folded.values(), *single, _declared(e)])
