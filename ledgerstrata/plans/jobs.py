"""Historical and incremental runs over a lake.

A run handles its dates together: one Bronze job per entity, one accounts job, one
classification job, then Gold. Only per-date counts and file names reach the
driver, never rows.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstrata import schemas as S
from ledgerstrata.operators import manifest as MF
from ledgerstrata.operators import runlog
from ledgerstrata.operators.accounts import (
    classify_accounts,
    first_sightings,
    keep_stamps,
    passing_accounts,
    silver_accounts,
    upsert_accounts,
)
from ledgerstrata.operators.bronze import SKIP, WRITE, load_plan, rows_per_date, with_bronze_audit
from ledgerstrata.operators.codes import silver_transaction_codes
from ledgerstrata.operators.gold import (
    daily_partials,
    daily_table,
    fold_daily,
    fold_weekly,
    weekly_partials,
    weekly_table,
)
from ledgerstrata.operators.quarantine import quarantine_accounts
from ledgerstrata.operators.reconcile import reconcile
from ledgerstrata.operators.transactions import classify_transactions, split_by_disposition
from ledgerstrata.plans.lake import Lake, on_dates
from ledgerstrata.sources import extracts
from ledgerstrata.sources.tables import (
    Scratch,
    current_path,
    drop_partitions,
    evenly_sized,
    replace_partitions,
    replace_table,
    small_table,
    table_exists,
)

logger = logging.getLogger(__name__)

_SOURCE_SCHEMAS = {"transactions": S.TRANSACTION_SOURCE, "accounts": S.ACCOUNT_SOURCE}
_LAYER = {"bronze": "BRONZE", "silver": "SILVER", "gold": "GOLD"}


def _now() -> datetime:
    return datetime.now(timezone.utc)


@dataclass
class Outcome:
    """What one model did for one date."""

    day: date | None
    status: str
    processed: int | None = None
    written: int | None = None
    rejected: int | None = None
    error: str | None = None


@dataclass
class Run:
    """One run: its identity, its lake, and the log rows it produces."""

    lake: Lake
    run_id: str
    kind: str
    now: datetime = field(default_factory=_now)

    def log(self, model: str, started: datetime, outcomes: Iterable[Outcome]) -> None:
        rows = [
            (
                self.run_id,
                self.kind,
                model,
                _LAYER[model.split("_", 1)[0]],
                o.day,
                started,
                _now(),
                o.status,
                o.processed,
                o.written,
                o.rejected,
                o.error,
            )
            for o in outcomes
        ]
        if rows:
            frame = small_table(self.lake.spark, rows, S.RUN_LOG)
            runlog.append_run_log(frame, self.lake.log_path)

    def record(self, entries: list[tuple]) -> None:
        """Put what a write left into the manifest."""
        frame = small_table(self.lake.spark, entries, S.MANIFEST)
        self.lake.manifest_journal().append(frame)

    def own(self, stamp: str) -> Column:
        """Rows this run has written."""
        return (F.col("_pipeline_run_id") == self.run_id) & (F.col(stamp) == F.lit(self.now))

    def attempt(
        self, model: str, days: Iterable[date | None], work: Callable[[], list[Outcome]]
    ) -> bool:
        """Run one model and log it whatever happens; True if no date failed."""
        started, days = _now(), list(days)
        try:
            outcomes = work()
        except Exception as error:  # every failure must reach the log
            outcomes = [Outcome(day, S.FAILED, error=str(error)) for day in days]
        self.log(model, started, outcomes)
        return all(o.status != S.FAILED for o in outcomes)


def _days(rows: DataFrame) -> set[date]:
    return {row["date"] for row in rows.select("date").distinct().collect()}


def _counts(rows: DataFrame) -> dict[date, int]:
    return {row["date"]: row["n"] for row in rows_per_date(rows, "n").collect()}


# ---------------------------------------------------------------------------
# Bronze
# ---------------------------------------------------------------------------
def bronze_rows_found(lake: Lake, entity: str, days: Iterable[date]) -> DataFrame:
    """(date, bronze_rows, sound) of the given days: the manifest against file footers.

    Only footers are read. A file that is missing, cut or unreadable makes its day
    unsound, and so does one the manifest does not know.
    """
    path, schema = lake.path("bronze", entity), lake.bronze(entity).schema
    days = list(days)
    expected = on_dates(MF.newest(lake.manifest(), f"bronze_{entity}"), days)
    if table_exists(lake.spark, path):
        tolerant = lake.spark.read.option("ignoreCorruptFiles", True).schema(schema).parquet(path)
        name = F.col("_metadata.file_name").alias("file")
        found = on_dates(tolerant, days).groupBy("date", name).agg(F.count("*").alias("rows"))
    else:
        found = expected.where(F.lit(False))
    return MF.audit(expected, found)


def bronze_actions(lake: Lake, entity: str, files: DataFrame) -> dict[date, str]:
    """Load action per date that has an extract.

    Dates that Bronze has never held need no counting. The others are counted on both
    sides; what the manifest and the files of a date do not agree on is written again.
    """
    paths = {row["path"]: row["date"] for row in files.collect()}
    actions = {day: WRITE for day in paths.values()}
    if not actions or not table_exists(lake.spark, lake.path("bronze", entity)):
        return actions
    stored = bronze_rows_found(lake, entity, actions)
    present = _days(stored)
    if not present:
        return actions
    recount = [path for path, day in paths.items() if day in present]
    source = extracts.scan_extracts(lake.spark, recount, _SOURCE_SCHEMAS[entity], lake.multi_line)
    plan = load_plan(rows_per_date(source, "source_rows"), stored)
    # A file that shrank to its header has no count of its own: rewrite it.
    stale = F.col("source_rows").isNull()
    decided = plan.select("date", F.when(stale, "REWRITE").otherwise(F.col("action")).alias("action"))
    return actions | {row["date"]: row["action"] for row in decided.collect()}


def load_bronze(run: Run, entity: str, days: list[date]) -> list[Outcome]:
    """Land every extract of the given days in one job."""
    lake = run.lake
    files = extracts.list_extracts(lake.spark, lake.source, entity, days)
    actions = bronze_actions(lake, entity, files)
    todo = sorted(day for day, action in actions.items() if action != SKIP)
    path = lake.path("bronze", entity)
    counts: dict[date, int] = {}
    if todo:
        paths = [row["path"] for row in on_dates(files, todo).collect()]
        rows = extracts.scan_extracts(lake.spark, paths, _SOURCE_SCHEMAS[entity], lake.multi_line)
        # A CSV split belongs to one day, so no shuffle is needed to group days.
        replace_partitions(with_bronze_audit(rows, run.run_id, run.now), path)
        stored = on_dates(lake.bronze(entity), todo)
        left = MF.by_file(stored, _SOURCE_SCHEMAS[entity].names, run.own("_ingested_at")).collect()
        left = drop_emptied(lake, path, left, todo)
        run.record(MF.entries(left, f"bronze_{entity}", todo, run.run_id, _now()))
        for row in left:
            counts[row["date"]] = counts.get(row["date"], 0) + row["rows"]
    if len(todo) < len(actions):
        counts |= _counts(on_dates(lake.bronze(entity), set(actions) - set(todo)))
    outcomes = []
    for day in days:
        if day not in actions:
            outcomes.append(Outcome(day, S.SKIPPED))
        elif day in todo:
            n = counts.get(day, 0)
            outcomes.append(Outcome(day, S.SUCCESS, n, n))
        else:
            outcomes.append(Outcome(day, S.SKIPPED, counts.get(day, 0), 0))
    return outcomes


def drop_emptied(lake: Lake, path: str, left: list[Row], days: Iterable[date]) -> list[Row]:
    """Drop what the days held before where the run has written no row for them.

    The write replaces the partitions of its rows; a day that has none left would keep
    its old ones. `left` says what is there and how much of it is the run's `own`; the part
    of the days that stay comes back.
    """
    written = {row["date"] for row in left if row["own"]}
    drop_partitions(lake.spark, path, set(days) - written)
    return [row for row in left if row["date"] in written]


def load_isolated(run: Run, entity: str, days: list[date]) -> list[Outcome]:
    """`load_bronze`, with a broken extract failing its own date only.

    All days are one job; if an extract breaks it, its halves are tried, down to the broken
    days. Any other fault, such as a full disk, fails all days at once.
    """
    try:
        return load_bronze(run, entity, days)
    except Exception as error:
        if not extracts.is_broken_extract(error):
            raise
        if len(days) == 1:
            return [Outcome(days[0], S.FAILED, error=str(error))]
        half = len(days) // 2
        return load_isolated(run, entity, days[:half]) + load_isolated(run, entity, days[half:])


def load_codes(run: Run) -> list[Outcome]:
    lake = run.lake
    source = extracts.scan_static(
        lake.spark, f"{lake.source}/transaction_codes.csv", S.CODE_SOURCE
    )
    path = lake.path("bronze", "transaction_codes")
    expected = source.count()
    if table_exists(lake.spark, path):
        tolerant = lake.spark.read.option("ignoreCorruptFiles", True).schema(S.BRONZE_CODES)
        if tolerant.parquet(current_path(lake.spark, path)).count() == expected:
            return [Outcome(None, S.SKIPPED, expected, 0)]
    replace_table(with_bronze_audit(source, run.run_id, run.now), path)
    return [Outcome(None, S.SUCCESS, expected, expected)]


# ---------------------------------------------------------------------------
# Silver
# ---------------------------------------------------------------------------
def build_codes(run: Run) -> list[Outcome]:
    lake = run.lake
    replace_table(
        silver_transaction_codes(lake.bronze_codes(), run.run_id),
        lake.path("silver", "transaction_codes"),
    )
    n = lake.silver_codes().count()
    return [Outcome(None, S.SUCCESS, n, n)]


def promoted_days(lake: Lake) -> set[date]:
    """Days whose account deltas are in the snapshot."""
    return _days(runlog.succeeded_dates(lake.run_log(), "silver_accounts"))


def follows_all(promoted: set[date], days: list[date]) -> bool:
    """True for one day later than every other day whose accounts are in the snapshot."""
    others = promoted - set(days)
    return len(days) == 1 and bool(others) and max(others) < days[0]


def build_accounts(run: Run, days: list[date]) -> list[Outcome]:
    """Bring the snapshot up to date; quarantine the given days' rejects.

    The day after all others only replaces the accounts it brings. Any other set of
    days rebuilds the snapshot from the deltas of these and all promoted days, so the
    order of loading does not show. Deltas that a broken run left in Bronze for other days
    wait for their own promotion. Rows that a rebuild finds unchanged keep their audit
    values. A day without deltas is a success: the snapshot covers
    it all the same.
    """
    lake = run.lake
    lake.require_built("silver_accounts", "silver", "accounts")
    promoted = promoted_days(lake)
    bronze = lake.bronze("accounts")
    fresh = classify_accounts(on_dates(bronze, days))
    if follows_all(promoted, days):
        delta = silver_accounts(passing_accounts(fresh), run.run_id, run.now)
        snapshot = upsert_accounts(lake.silver_accounts(), delta)
    else:
        everything = passing_accounts(classify_accounts(on_dates(bronze, promoted | set(days))))
        snapshot = silver_accounts(everything, run.run_id, run.now)
        if promoted:
            snapshot = keep_stamps(snapshot, lake.silver_accounts())
    replace_table(snapshot, lake.path("silver", "accounts"))
    path = lake.path("silver", "accounts_rejected")
    rejects = quarantine_accounts(fresh, run.run_id, run.now)
    replace_partitions(evenly_sized(rejects, "date"), path)
    stored = on_dates(lake.rejected_accounts(), days)
    left = MF.by_date(stored, S.ACCOUNT_SOURCE.names, run.own("_rejected_at")).collect()
    rejected = {row["date"]: row["rows"] for row in drop_emptied(lake, path, left, days)}
    seen = _counts(on_dates(lake.bronze("accounts"), days))
    return [
        Outcome(d, S.SUCCESS, n := seen.get(d, 0), n - rejected.get(d, 0), rejected.get(d, 0))
        for d in days
    ]


def known_accounts(lake: Lake, days: list[date]) -> DataFrame:
    """(account_id, known_from) as far as the given days can tell.

    Only promoted days count. For the day after all others the snapshot is enough, which
    holds nothing later; other days need the date of each account's first delta.
    """
    lake.require_built("silver_accounts", "silver", "accounts")
    promoted = promoted_days(lake)
    if follows_all(promoted, days):
        return lake.silver_accounts().select("account_id", F.lit(days[0]).alias("known_from"))
    deltas = on_dates(lake.bronze("accounts"), promoted | set(days))
    return first_sightings(passing_accounts(classify_accounts(deltas)))


def require_accounts_ready(lake: Lake, days: list[date]) -> None:
    """Transactions must not be judged against accounts older than their input."""
    ready = runlog.accounts_ready(lake.run_log()).where(F.col("accounts_ready"))
    late = sorted(set(days) - _days(ready.withColumnRenamed("processing_date", "date")))
    if late:
        raise RuntimeError(f"silver accounts not current for {', '.join(map(str, late))}")


def build_transactions(run: Run, days: list[date]) -> list[Outcome]:
    """Classify the given days together and write both outcomes in one job.

    Days that succeeded earlier supply the ids already taken: only those of the
    judgements that hold, so a repeat cannot see its own rows.
    """
    lake = run.lake
    require_accounts_ready(lake, days)
    lake.require_built("silver_transaction_codes", "silver", "transaction_codes")
    done = runlog.succeeded_dates(lake.run_log(), "silver_transactions")
    others = _days(done) - set(days)
    accepted_before = taken_ids(lake, others) if others else None
    with Scratch(lake.spark, "rulings") as scratch:
        classified = classify_transactions(
            on_dates(lake.addressed_transactions(), days).drop("_pipeline_run_id"),
            lake.silver_codes(),
            scratch.keep(known_accounts(lake, days)),
            accepted_before,
            keep=scratch.keep,
        )
        outcome = split_by_disposition(classified, run.run_id, run.now)
        replace_partitions(
            evenly_sized(outcome, "disposition", "date"),
            lake.path("silver", "transactions"),
            "disposition",
            "date",
        )
    left = outcomes_left(run, days)
    checked = reconcile(
        on_dates(lake.bronze("transactions"), days),
        on_dates(lake.silver_transactions(), days),
        on_dates(lake.rejected_transactions(), days),
    )
    counted = {row["date"]: row for row in checked.collect()}
    outcomes = []
    for day in days:
        row = counted.get(day)
        if row is None:
            outcomes.append(Outcome(day, S.SUCCESS, 0, 0, 0))
            continue
        sound = row["delta"] == 0
        outcomes.append(
            Outcome(
                day,
                S.SUCCESS if sound else S.FAILED,
                row["bronze_rows"],
                row["silver_rows"],
                row["quarantine_rows"],
                None if sound else f"{row['delta']} rows unaccounted for",
            )
        )
    record_judgement(run, days, left)
    return outcomes


def outcomes_left(run: Run, days: list[date]) -> dict[str, list[Row]]:
    """What the write of both outcomes has left of the given days, by manifest table."""
    lake, left = run.lake, {}
    content = [c for c in S.SILVER_TRANSACTIONS.names if c not in S.STAMPS]
    reasons = [*S.TRANSACTION_SOURCE.names, "_rejection_reason"]
    for table, rows, disposition, columns, stamp in (
        ("silver_transactions", lake.silver_transactions(), S.ACCEPTED, content, "_promoted_at"),
        ("silver_quarantine", lake.rejected_transactions(), S.REJECTED, reasons, "_rejected_at"),
    ):
        counted = MF.by_date(on_dates(rows, days), columns, run.own(stamp)).collect()
        left[table] = drop_emptied(lake, lake.outcome_path(disposition), counted, days)
    return left


def judgements(lake: Lake, days: Iterable[date]) -> DataFrame:
    """(date, judged_at) of the judgements in force for the given days."""
    judged = lake.versions("silver_transactions")["silver_transactions"]
    rows = [(day, judged[day]["recorded_at"]) for day in days if day in judged]
    schema = T.StructType([f for f in S.ACCEPTED_IDS.fields if f.name != "transaction_id"])
    return small_table(lake.spark, rows, schema)


def taken_ids(lake: Lake, days: Iterable[date]) -> DataFrame:
    """Ids accepted on the given days, by bucket; a lost table is filled from Silver."""
    table, held = lake.accepted_ids(), judgements(lake, days)
    if not table.exists():
        silver = on_dates(lake.silver_transactions(), days)
        table.append(silver.join(F.broadcast(held), "date"))
    return table.valid(held)


def record_judgement(run: Run, days: list[date], left: dict[str, list[Row]]) -> None:
    """Store the ids the days have taken, and what they were judged from.

    The ids carry the time of the manifest's entries. They come first: without an entry
    they are of no judgement, and nobody reads them.
    """
    lake, when = run.lake, _now()
    silver = on_dates(lake.silver_transactions(), days)
    stamp = F.lit(when).cast("timestamp").alias("judged_at")
    lake.accepted_ids().append(silver.select("transaction_id", "date", stamp))
    bronze = lake.versions("bronze_transactions")["bronze_transactions"].values()
    made = [MF.entries(rows, table, days, run.run_id, when, bronze) for table, rows in left.items()]
    run.record([entry for entries in made for entry in entries])


def moved_days(lake: Lake, days: Iterable[date]) -> set[date]:
    """Of the given days, those whose Bronze rows are not the ones they were judged from."""
    kept = lake.versions("bronze_transactions", "silver_transactions")
    judged, bronze = kept["silver_transactions"], kept["bronze_transactions"]
    return {day for day in days if not MF.holds(judged.get(day), bronze.get(day))}


# ---------------------------------------------------------------------------
# Gold
# ---------------------------------------------------------------------------
def refresh_partials(run: Run, gate: list[date]) -> None:
    """Bring the partial aggregates of the gated dates up to date with Silver.

    Only dates whose Silver rows the partials do not stand for yet are read. The manifest names them last, so that a broken refresh is done again.
    """
    lake = run.lake
    kept = lake.versions("silver_transactions", "gold_partials")
    silver, made = kept["silver_transactions"], kept["gold_partials"]
    due = [day for day in gate if not MF.holds(made.get(day), silver.get(day))]
    if not due:
        return
    rows = on_dates(lake.silver_transactions(), due)
    tables = {"daily_partials": daily_partials, "weekly_partials": weekly_partials}
    for name, build in tables.items():
        path = lake.path("gold", name)
        drop_partitions(lake.spark, path, due)
        replace_partitions(evenly_sized(build(rows, "date"), "date"), path)
    written = on_dates(lake.daily_partials(), due)
    counted = MF.by_date(written, [c for c in written.columns if c != "date"]).collect()
    run.record(MF.entries(counted, "gold_partials", due, run.run_id, _now(), silver.values()))


def build_gold(run: Run, model: str, gate: list[date]) -> None:
    """Fold the partials of all gated dates; Silver itself is not read."""
    lake, codes = run.lake, run.lake.silver_codes()
    if model == "gold_daily_summary":
        figures = fold_daily(on_dates(lake.daily_partials(), gate), codes)
        table = daily_table(figures, run.run_id, run.now)
        replace_table(table.orderBy("transaction_date"), lake.path("gold", "daily_summary"))
    else:
        figures = fold_weekly(on_dates(lake.weekly_partials(), gate), codes)
        table = weekly_table(figures, lake.silver_accounts(), run.run_id, run.now)
        replace_table(
            table.orderBy("week_start_date", "account_id"),
            lake.path("gold", "weekly_account_summary"),
        )


def publish_gold(run: Run, days: list[date]) -> bool:
    """Recompute both summaries and log the dates they newly cover.

    These are the run's own published dates and any published date Gold missed
    before; the log does not grow with the length of the history.
    """
    lake = run.lake
    log = lake.run_log()
    gate = sorted(_days(lake.promotion_gate()))
    tables = {"gold_daily_summary": lake.gold_daily, "gold_weekly_account_summary": lake.gold_weekly}
    covered = _days(runlog.succeeded_dates(log, *tables))
    logged = [day for day in gate if day not in covered or day in days]
    refreshed = False

    def build(model: str) -> list[Outcome]:
        nonlocal refreshed
        if not refreshed:
            refresh_partials(run, gate)
            refreshed = True
        build_gold(run, model, gate)
        n = tables[model]().count()
        return [Outcome(day, S.SUCCESS, written=n) for day in logged]

    return all(run.attempt(model, logged, lambda m=model: build(m)) for model in tables)


def failed_days(run: Run, model: str) -> set[date]:
    """Dates whose attempt in this run failed."""
    log = run.lake.run_log().where((F.col("run_id") == run.run_id) & (F.col("model_name") == model))
    return _days(log.where(F.col("status") == S.FAILED).withColumnRenamed("processing_date", "date"))


def advance_watermark(run: Run) -> date | None:
    """Move the watermark to the last date before the first open one."""
    mark = runlog.watermark_from_log(run.lake.run_log()).first()
    day = mark["last_processed_date"] if mark else None
    if day is not None:
        runlog.write_watermark(run.lake.spark, run.lake.control_path, day, run.run_id, run.now)
    return day


def tidy(run: Run) -> None:
    """Fold what many small appends have left: log, manifest and buckets of ids."""
    lake = run.lake
    lake.log_journal().compact()
    lake.manifest_journal().compact()
    lake.accepted_ids().compact(
        lambda: judgements(lake, _days(runlog.succeeded_dates(lake.run_log(), "silver_transactions")))
    )


# ---------------------------------------------------------------------------
# Runs
# ---------------------------------------------------------------------------
def _process(run: Run, days: list[date]) -> date | None:
    """Bronze, Silver, Gold and watermark for the given days; None if held back."""
    lake = run.lake
    for journal in (lake.log_journal(), lake.manifest_journal()):
        for row in journal.broken().collect():
            logger.warning("unreadable file %s is left out", row["file"])
    mark = runlog.read_watermark(lake.spark, lake.control_path)
    asked = days
    for entity in ("accounts", "transactions"):
        loaded = run.attempt(f"bronze_{entity}", days, lambda e=entity: load_isolated(run, e, days))
        if not loaded:
            # A broken extract costs its own date; the others go on.
            days = sorted(set(days) - failed_days(run, f"bronze_{entity}"))
    if not days:
        return None
    done = _days(runlog.succeeded_dates(lake.run_log(), "silver_transactions"))
    arrived = _days(extracts.list_extracts(lake.spark, lake.source, "transactions", days))
    # A day whose Bronze rows have changed since it was judged is judged again.
    batch = sorted((arrived - done) | moved_days(lake, done & set(days)))
    absent = sorted(set(days) - arrived - done)

    # Account deltas are promoted whether or not transactions came that day.
    if not run.attempt("silver_accounts", days, lambda: build_accounts(run, days)):
        return None
    run.log("silver_transactions", _now(), [Outcome(day, S.SKIPPED) for day in absent])
    if batch:
        promoted = run.attempt(
            "silver_transactions", batch, lambda: build_transactions(run, batch)
        )
        if not promoted:
            return None
        run.log("silver_quarantine", _now(), [Outcome(day, S.SUCCESS) for day in batch])
    if not publish_gold(run, days):
        return None
    reached = advance_watermark(run)
    tidy(run)
    return reached if days == asked or reached != mark else None


def run_historical(
    lake: Lake, start: date, end: date, run_id: str, now: datetime | None = None
) -> date | None:
    """Process every date of a range; returns the watermark, None if it stayed.

    Dates that succeeded before are judged again only if their Bronze rows have changed,
    and missing extracts hold the watermark before the gap without failing the run.
    """
    run = Run(lake, run_id, S.HISTORICAL, now or _now())
    codes_done = lake.run_log().where(
        (F.col("model_name") == "silver_transaction_codes") & (F.col("status") == S.SUCCESS)
    )
    if codes_done.isEmpty():
        loaded = run.attempt("bronze_transaction_codes", [None], lambda: load_codes(run))
        if not (loaded and run.attempt("silver_transaction_codes", [None], lambda: build_codes(run))):
            return None
    days = [row["date"] for row in extracts.calendar(lake.spark, start, end).collect()]
    return _process(run, sorted(days))


def run_incremental(lake: Lake, run_id: str, now: datetime | None = None) -> date | None:
    """Process the date after the watermark.

    Nothing happens, and None comes back, if no extract has arrived for it or it
    was processed already. A failure is logged and leaves the watermark alone.
    """
    run = Run(lake, run_id, S.INCREMENTAL, now or _now())
    day = runlog.require_next_date(lake.spark, lake.control_path)
    arrived: set[date] = set()
    for entity in ("transactions", "accounts"):
        arrived |= _days(extracts.list_extracts(lake.spark, lake.source, entity, [day]))
    done = _days(runlog.succeeded_dates(lake.run_log(), "silver_transactions"))
    if not arrived or day in done:
        return None
    return _process(run, [day])
