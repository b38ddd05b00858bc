"""Compare registered queries with their SQL: `python tests/oracle_compare.py [sf] [names…]`."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry_points  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def plain(rows, columns: list[str]) -> list[tuple]:
    """Rows as sorted tuples of text, columns in name order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(row[i]) for i in order) for row in rows)


def compare(spark: SparkSession, connection, sf_dir: str, name: str, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    frame = entry_points.queries()[name](spark, sf_dir)
    ours = plain(frame.collect(), frame.columns)
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    theirs = plain(result.fetchall(), columns)
    if sorted(frame.columns) != sorted(columns):
        return f"columns {sorted(set(frame.columns) ^ set(columns))}"
    types = {d[0]: str(d[1]) for d in result.description}
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    if ours != theirs:
        pairs = [(a, b) for a, b in zip(ours, theirs) if a != b]
        return f"{len(pairs)} rows differ, e.g. {pairs[0]} ({sorted(types.items())})"
    return None


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    connection = duck(sf_dir)
    statements = entry_points.oracle_sql()
    names = sys.argv[2:] or list(entry_points.queries())
    failed = 0
    for name in names:
        started = time.time()
        if name not in statements:
            print(f"NOSQL {name}")
            continue
        try:
            problem = compare(session, connection, sf_dir, name, statements[name])
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok   ' if problem is None else 'FAIL '} {name} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed}/{len(names)}")
