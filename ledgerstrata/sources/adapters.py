"""Test tables read as ledger inputs.

The star-schema tables know neither bad channels nor unknown codes, so the
adapters bring such rows about by fixed arithmetic on the keys.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstrata import schemas as S

RUN_ID = "20240201_0a1b2c3d"
RUN_TIME = datetime(2024, 2, 1, 6, 0, 0, tzinfo=timezone.utc)

# Code, description, indicator, type, affects balance.
CODE_ROWS = [
    ("PURCH01", "Purchase", "DR", "PURCHASE", True),
    ("PAY01", "Payment", "CR", "PAYMENT", True),
    ("FEE01", "Annual Fee", "DR", "FEE", True),
    ("INT01", "Interest Charge", "DR", "INTEREST", True),
]

_EVENT_CODE = """
    CASE event_type WHEN 'purchase' THEN 'PURCH01' WHEN 'click' THEN 'PAY01'
                    WHEN 'view' THEN 'FEE01' WHEN 'signup' THEN 'INT01' ELSE 'ERR01' END"""


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _with_audit(rows: DataFrame, entity: str) -> DataFrame:
    name = F.concat(F.lit(f"{entity}_"), F.col("date").cast("string"), F.lit(".csv"))
    return rows.withColumns(
        {
            "_source_file": name,
            "_ingested_at": F.lit(RUN_TIME).cast("timestamp"),
            "_pipeline_run_id": F.lit(RUN_ID),
        }
    )


def event_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as Bronze transactions, partitioned by the event's own date."""
    rows = read(spark, sf_dir, "events").selectExpr(
        """CAST(CASE WHEN event_id % 20 = 0 THEN event_id div 2
                     WHEN event_id % 33 = 1 THEN event_id - 1
                     ELSE event_id END AS STRING) AS transaction_id""",
        "CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(user_id AS STRING) END AS account_id",
        "CAST(ts AS DATE) AS transaction_date",
        "CAST(CAST(value AS DECIMAL(18,2)) - 2.00BD + CASE WHEN event_id % 101 = 7 THEN 0.005BD"
        " WHEN event_id % 101 = 8 THEN 0.0000005BD ELSE 0BD END AS DECIMAL(24,7)) AS amount",
        f"{_EVENT_CODE} AS transaction_code",
        """CASE WHEN event_type = 'purchase'
                THEN concat('shop-', CAST(user_id % 50 AS STRING)) END AS merchant_name""",
        """CASE WHEN event_id % 13 = 0 THEN 'DRIVE_THRU'
                WHEN event_id % 3 = 0 THEN 'IN_STORE' ELSE 'ONLINE' END AS channel""",
        "event_id AS seq",
        "event_id AS _row_id",
        "CAST(ts AS DATE) AS date",
    )
    return _with_audit(rows, "transactions")


def customer_accounts(spark: SparkSession, sf_dir: str, full: bool = False) -> DataFrame:
    """`customer` as account deltas that arrive over ten days.

    `full` adds missing credit limits and a second, later delta for every fourth
    account, so that required fields and the upsert have something to do.
    """
    limit = "CASE WHEN c_custkey % 89 = 88 THEN NULL ELSE 5000.00BD END" if full else "5000.00BD"
    deltas = "CASE WHEN c_custkey % 4 = 0 THEN array(0, 1) ELSE array(0) END" if full else "array(0)"
    rows = (
        read(spark, sf_dir, "customer")
        .selectExpr("*", f"explode({deltas}) AS again")
        .selectExpr(
            "CAST(c_custkey AS STRING) AS account_id",
            "c_name AS customer_name",
            "CASE WHEN c_acctbal < 0 THEN 'DELINQUENT' ELSE 'ACTIVE' END AS account_status",
            f"CAST({limit} AS DECIMAL(18,2)) AS credit_limit",
            "CAST(CAST(c_acctbal AS DECIMAL(18,2)) + 100 * again AS DECIMAL(18,2)) AS current_balance",
            "DATE '2020-01-01' AS open_date",
            "DATE '2024-01-01' AS billing_cycle_start",
            "DATE '2024-01-31' AS billing_cycle_end",
            "date_add(DATE '2024-01-01', CAST(c_custkey % 10 AS INT) + 10 * again) AS date",
        )
    )
    return _with_audit(rows, "accounts")


def event_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The code table for the event types that occur; errors have no code."""
    occurring = (
        read(spark, sf_dir, "events")
        .select("event_type")
        .distinct()
        .selectExpr(f"{_EVENT_CODE} AS transaction_code")
    )
    return standard_codes(spark).join(occurring, "transaction_code", "left_semi")


def standard_codes(spark: SparkSession) -> DataFrame:
    # As a VALUES relation its size is known when joins are planned.
    values = ", ".join(str(row) for row in CODE_ROWS)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(S.CODE_SOURCE.names)})").withColumns(
        {
            "_source_file": F.lit("transaction_codes.csv"),
            "_ingested_at": F.lit(RUN_TIME).cast("timestamp"),
            "_pipeline_run_id": F.lit(RUN_ID),
        }
    )


LINEITEM_ORDER = ("l_partkey", "l_suppkey", "l_extendedprice")


def lineitem_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`lineitem` as Bronze transactions: natural duplicates, about 2,500 dates."""
    rows = read(spark, sf_dir, "lineitem").selectExpr(
        "concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS transaction_id",
        "CAST(l_suppkey AS STRING) AS account_id",
        "CAST(l_shipdate AS DATE) AS transaction_date",
        "CAST(l_extendedprice AS DECIMAL(18,2)) - 3000.00BD AS amount",
        """CASE l_returnflag WHEN 'A' THEN 'PURCH01' WHEN 'R' THEN 'PAY01'
                             ELSE 'FEE01' END AS transaction_code""",
        "CAST(NULL AS STRING) AS merchant_name",
        """CASE WHEN l_quantity = 50 THEN 'DRIVE_THRU'
                WHEN l_linestatus = 'O' THEN 'ONLINE' ELSE 'IN_STORE' END AS channel""",
        *LINEITEM_ORDER,
        "struct(_metadata.file_path, _metadata.row_index) AS _row_id",
        "CAST(l_shipdate AS DATE) AS date",
    )
    return _with_audit(rows, "transactions")


def supplier_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "supplier").selectExpr(
        "CAST(s_suppkey AS STRING) AS account_id",
        "s_name AS customer_name",
        "CASE WHEN s_acctbal < 0 THEN 'DELINQUENT' ELSE 'ACTIVE' END AS account_status",
        "CAST(5000.00 AS DECIMAL(18,2)) AS credit_limit",
        "CAST(s_acctbal AS DECIMAL(18,2)) AS current_balance",
        "DATE '1990-01-01' AS open_date",
        "DATE '1995-01-01' AS billing_cycle_start",
        "DATE '1995-01-31' AS billing_cycle_end",
        "date_add(DATE '1995-01-01', CAST(s_suppkey % 1000 AS INT)) AS date",
    )
    return _with_audit(rows, "accounts")


# Models in the order a run logs them.
LOGGED_MODELS = (
    ("bronze_accounts", "BRONZE"),
    ("bronze_transactions", "BRONZE"),
    ("silver_accounts", "SILVER"),
    ("silver_transactions", "SILVER"),
    ("gold_daily_summary", "GOLD"),
    ("gold_weekly_account_summary", "GOLD"),
)


def event_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run log over the dates of `events`.

    Every model runs once per date. On days of the month that leave 3 when divided
    by 7, `silver_transactions` fails first and, before day 24, succeeds on a second
    attempt; on day 27 the accounts snapshot is older than its Bronze input.
    """
    days = read(spark, sf_dir, "events").groupBy(F.expr("CAST(ts AS DATE)").alias("d")).agg(
        F.count("*").alias("n")
    )
    models = F.array(
        *[
            F.struct(F.lit(m).alias("model"), F.lit(layer).alias("layer"), F.lit(i).alias("step"))
            for i, (m, layer) in enumerate(LOGGED_MODELS, start=1)
        ]
    )
    attempts = days.select("d", "n", F.inline(models)).selectExpr(
        "*",
        "day(d) % 7 = 3 AND model = 'silver_transactions' AS shaky",
        """explode(CASE WHEN day(d) % 7 = 3 AND model = 'silver_transactions' AND day(d) < 24
                        THEN array(1, 2) ELSE array(1) END) AS attempt""",
    )
    return attempts.selectExpr(
        "concat('run-', CAST(d AS STRING), '-', CAST(attempt AS STRING)) AS run_id",
        "'HISTORICAL' AS pipeline_type",
        "model AS model_name",
        "layer",
        "d AS processing_date",
        """timestamp_seconds(unix_date(d) * 86400 + attempt * 3600 + step * 60
             - CASE WHEN day(d) = 27 AND model = 'silver_accounts' THEN 7200 ELSE 0 END)
             AS started_at""",
        """timestamp_seconds(unix_date(d) * 86400 + attempt * 3600 + step * 60 + 30
             - CASE WHEN day(d) = 27 AND model = 'silver_accounts' THEN 7200 ELSE 0 END)
             AS completed_at""",
        "CASE WHEN shaky AND attempt = 1 THEN 'FAILED' ELSE 'SUCCESS' END AS status",
        "n AS records_processed",
        "CASE WHEN shaky AND attempt = 1 THEN NULL ELSE n END AS records_written",
        "CAST(NULL AS BIGINT) AS records_rejected",
        """CASE WHEN shaky AND attempt = 1 THEN concat('cannot read /data/bronze/',
             CAST(d AS STRING), '/part.parquet: ', CAST(n AS STRING), ' rows') END AS error_message""",
    )
