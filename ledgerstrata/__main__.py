"""Run a lake from the command line, e.g. under spark-submit.

    python -m ledgerstrata historical --lake L --source S --start-date D --end-date D
    python -m ledgerstrata incremental --lake L --source S
    python -m ledgerstrata verify --lake L --source S --end-date D
"""

from __future__ import annotations

import argparse
import sys
import uuid
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ledgerstrata import schemas as S
from ledgerstrata.operators.runlog import parse_day
from ledgerstrata.plans.jobs import run_historical, run_incremental
from ledgerstrata.plans.lake import Lake
from ledgerstrata.plans.verify import lake_checks
from ledgerstrata.sources.tables import configure


def new_run_id(now: datetime) -> str:
    """`YYYYMMDD_` and eight hexadecimal digits."""
    return f"{now:%Y%m%d}_{uuid.uuid4().hex[:8]}"


def _arguments(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="ledgerstrata")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("historical", "incremental", "verify"):
        command = commands.add_parser(name)
        command.add_argument("--lake", required=True, help="folder of the tables")
        command.add_argument("--source", required=True, help="folder of the extracts")
        if name == "historical":
            command.add_argument("--start-date", required=True, type=parse_day)
        if name != "incremental":
            command.add_argument("--end-date", required=True, type=parse_day)
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    """Exit code 0 if the run did not fail, or every check passed."""
    options = _arguments(sys.argv[1:] if argv is None else argv)
    spark = configure(SparkSession.builder.appName("ledgerstrata").getOrCreate())
    lake = Lake(spark, options.lake, options.source)
    if options.command == "verify":
        rows = lake_checks(lake, options.end_date).orderBy("check_id").collect()
        for row in rows:
            print(f"{'FAIL' if row['violations'] else 'PASS'}  {row['check_id']}  {row['violations']}")
        return int(any(row["violations"] for row in rows))
    now = datetime.now(timezone.utc)
    run_id = new_run_id(now)
    if options.command == "historical":
        mark = run_historical(lake, options.start_date, options.end_date, run_id, now)
    else:
        mark = run_incremental(lake, run_id, now)
    failed = lake.run_log().where((F.col("run_id") == run_id) & (F.col("status") == S.FAILED))
    broken = [f"{r['model_name']} {r['processing_date']}: {r['error_message']}" for r in failed.collect()]
    print("\n".join([f"run {run_id}, watermark {mark}", *broken]))
    return int(bool(broken))


if __name__ == "__main__":
    sys.exit(main())
