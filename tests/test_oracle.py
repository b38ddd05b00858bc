"""A sample of the registered queries against their SQL; the script runs all."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import types as T

from ledgerstrata.plans import oracle, registry
from ledgerstrata.sources import extracts
from tests.oracle_compare import compare, duck, entry_points

SMALL = "/root/testdata/sf0.001"
SAMPLE = [
    "transactions_classified",
    "transactions_classified_lineitem",
    "silver_accounts",
    "quarantine_all",
    "gold_daily_summary",
    "gold_weekly_account_summary",
    "bronze_load_plan",
    "watermark",
    "accounts_ready",
    "check_declared",
]
needs_tables = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


def test_every_query_has_sql():
    """The training-data queries are apart: not all of them can be said in SQL."""
    assert set(registry.QUERIES) == set(oracle.oracle_sql())
    assert set(registry.QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@needs_tables
@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, name):
    sql = entry_points.oracle_sql()[name]
    assert compare(spark, duck(SMALL), SMALL, name, sql) is None


@needs_tables
def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() == 30


def test_extracts_spell_amounts_in_full(spark, tmp_path):
    rows = spark.sql("""SELECT CAST(v AS DECIMAL(24,7)) AS amount, DATE '2024-01-02' AS date
                        FROM VALUES ('0'), ('0.0000005'), ('-12.5') AS t(v)""")
    registry.dump_extracts(rows, "transactions", ["amount"], str(tmp_path))
    schema = T.StructType([T.StructField("amount", T.StringType())])
    got = extracts.scan_entity(spark, str(tmp_path), "transactions", schema).select("amount").collect()
    assert {r["amount"] for r in got} == {"0.0000000", "0.0000005", "-12.5000000"}
