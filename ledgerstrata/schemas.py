"""Table schemas and the fixed vocabularies of the ledger."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
# Transaction amounts keep what they say; finer ones are rejected, never rounded.
AMOUNT = T.DecimalType(24, 6)
GOLD_MONEY = T.DecimalType(18, 3)

# ---------------------------------------------------------------------------
# They must equal the published ones for results to agree.
# ---------------------------------------------------------------------------
NULL_REQUIRED_FIELD = "NULL_REQUIRED_FIELD"
INVALID_AMOUNT = "INVALID_AMOUNT"
DUPLICATE_TRANSACTION_ID = "DUPLICATE_TRANSACTION_ID"
INVALID_TRANSACTION_CODE = "INVALID_TRANSACTION_CODE"
INVALID_CHANNEL = "INVALID_CHANNEL"
INVALID_ACCOUNT_STATUS = "INVALID_ACCOUNT_STATUS"

TRANSACTION_REASONS = (
    NULL_REQUIRED_FIELD,
    INVALID_AMOUNT,
    DUPLICATE_TRANSACTION_ID,
    INVALID_TRANSACTION_CODE,
    INVALID_CHANNEL,
)
ACCOUNT_REASONS = (NULL_REQUIRED_FIELD, INVALID_ACCOUNT_STATUS)
ALL_REASONS = TRANSACTION_REASONS + (INVALID_ACCOUNT_STATUS,)

CHANNELS = ("ONLINE", "IN_STORE")
ACCOUNT_STATUSES = ("ACTIVE", "SUSPENDED", "CLOSED")
TRANSACTION_TYPES = ("PURCHASE", "PAYMENT", "FEE", "INTEREST")
DEBIT, CREDIT = "DR", "CR"
LAYERS = ("BRONZE", "SILVER", "GOLD")
SUCCESS, FAILED, SKIPPED = "SUCCESS", "FAILED", "SKIPPED"
STATUSES = (SUCCESS, FAILED, SKIPPED)
HISTORICAL, INCREMENTAL = "HISTORICAL", "INCREMENTAL"


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _extend(base: T.StructType, *fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType(base.fields + [T.StructField(n, t) for n, t in fields])


# ---------------------------------------------------------------------------
# Source extracts. Nothing is inferred: a CSV field lands byte for byte.
# ---------------------------------------------------------------------------
TRANSACTION_SOURCE = _strings(
    "transaction_id",
    "account_id",
    "transaction_date",
    "amount",
    "transaction_code",
    "merchant_name",
    "channel",
)
ACCOUNT_SOURCE = _strings(
    "account_id",
    "customer_name",
    "account_status",
    "credit_limit",
    "current_balance",
    "open_date",
    "billing_cycle_start",
    "billing_cycle_end",
)
CODE_SOURCE = _strings(
    "transaction_code",
    "description",
    "debit_credit_indicator",
    "transaction_type",
    "affects_balance",
)

_BRONZE_AUDIT = (
    ("_source_file", T.StringType()),
    ("_ingested_at", T.TimestampType()),
    ("_pipeline_run_id", T.StringType()),
)
_DATE = ("date", T.DateType())

BRONZE_TRANSACTIONS = _extend(TRANSACTION_SOURCE, *_BRONZE_AUDIT, _DATE)
BRONZE_ACCOUNTS = _extend(ACCOUNT_SOURCE, *_BRONZE_AUDIT, _DATE)
BRONZE_CODES = _extend(CODE_SOURCE, *_BRONZE_AUDIT)

SILVER_CODES = T.StructType(
    [
        T.StructField("transaction_code", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("debit_credit_indicator", T.StringType()),
        T.StructField("transaction_type", T.StringType()),
        T.StructField("affects_balance", T.BooleanType()),
        T.StructField("_source_file", T.StringType()),
        T.StructField("_bronze_ingested_at", T.TimestampType()),
        T.StructField("_pipeline_run_id", T.StringType()),
    ]
)
SILVER_ACCOUNTS = T.StructType(
    [
        T.StructField("account_id", T.StringType()),
        T.StructField("customer_name", T.StringType()),
        T.StructField("account_status", T.StringType()),
        T.StructField("credit_limit", MONEY),
        T.StructField("current_balance", MONEY),
        T.StructField("open_date", T.DateType()),
        T.StructField("billing_cycle_start", T.DateType()),
        T.StructField("billing_cycle_end", T.DateType()),
        T.StructField("_source_file", T.StringType()),
        T.StructField("_bronze_ingested_at", T.TimestampType()),
        T.StructField("_pipeline_run_id", T.StringType()),
        T.StructField("_record_valid_from", T.TimestampType()),
    ]
)
SILVER_TRANSACTIONS = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("account_id", T.StringType()),
        T.StructField("transaction_date", T.DateType()),
        T.StructField("amount", AMOUNT),
        T.StructField("transaction_code", T.StringType()),
        T.StructField("merchant_name", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("_source_file", T.StringType()),
        T.StructField("_bronze_ingested_at", T.TimestampType()),
        T.StructField("_is_resolvable", T.BooleanType()),
        T.StructField("_signed_amount", AMOUNT),
        T.StructField("_pipeline_run_id", T.StringType()),
        T.StructField("_promoted_at", T.TimestampType()),
        T.StructField("date", T.DateType()),
    ]
)

_REJECT_AUDIT = (
    ("_source_file", T.StringType()),
    ("_pipeline_run_id", T.StringType()),
    ("_rejected_at", T.TimestampType()),
    ("_rejection_reason", T.StringType()),
)
QUARANTINE_TRANSACTIONS = _extend(TRANSACTION_SOURCE, *_REJECT_AUDIT, _DATE)
QUARANTINE_ACCOUNTS = _extend(ACCOUNT_SOURCE, *_REJECT_AUDIT, _DATE)
# The shape of the union of rejects while there is nothing to unite.

# Accepted and rejected transactions are written by one job into one tree,
# split by `disposition`. Rejects keep the two parsed fields as raw text.
ACCEPTED, REJECTED = "accepted", "rejected"
RAW_FIELDS = {"transaction_date": "_raw_transaction_date", "amount": "_raw_amount"}

_TYPE_CELL = T.StructType(
    [T.StructField("count", T.LongType()), T.StructField("sum", GOLD_MONEY)]
)
GOLD_DAILY = T.StructType(
    [
        T.StructField("transaction_date", T.DateType()),
        T.StructField("total_transactions", T.LongType()),
        T.StructField("total_signed_amount", GOLD_MONEY),
        T.StructField(
            "transactions_by_type",
            T.StructType([T.StructField(t, _TYPE_CELL) for t in TRANSACTION_TYPES]),
        ),
        T.StructField("online_transactions", T.LongType()),
        T.StructField("instore_transactions", T.LongType()),
        T.StructField("_computed_at", T.TimestampType()),
        T.StructField("_pipeline_run_id", T.StringType()),
        T.StructField("_source_period_start", T.DateType()),
        T.StructField("_source_period_end", T.DateType()),
    ]
)
GOLD_WEEKLY = T.StructType(
    [
        T.StructField("week_start_date", T.DateType()),
        T.StructField("week_end_date", T.DateType()),
        T.StructField("account_id", T.StringType()),
        T.StructField("total_purchases", T.LongType()),
        T.StructField("avg_purchase_amount", GOLD_MONEY),
        T.StructField("total_payments", GOLD_MONEY),
        T.StructField("total_fees", GOLD_MONEY),
        T.StructField("total_interest", GOLD_MONEY),
        T.StructField("closing_balance", GOLD_MONEY),
        T.StructField("_computed_at", T.TimestampType()),
        T.StructField("_pipeline_run_id", T.StringType()),
    ]
)

RUN_LOG = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("pipeline_type", T.StringType()),
        T.StructField("model_name", T.StringType()),
        T.StructField("layer", T.StringType()),
        T.StructField("processing_date", T.DateType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("completed_at", T.TimestampType()),
        T.StructField("status", T.StringType()),
        T.StructField("records_processed", T.LongType()),
        T.StructField("records_written", T.LongType()),
        T.StructField("records_rejected", T.LongType()),
        T.StructField("error_message", T.StringType()),
    ]
)
RUN_LOG_REQUIRED = (
    "run_id",
    "pipeline_type",
    "model_name",
    "layer",
    "started_at",
    "completed_at",
    "status",
)
CONTROL = T.StructType(
    [
        T.StructField("last_processed_date", T.DateType()),
        T.StructField("updated_at", T.TimestampType()),
        T.StructField("updated_by_run_id", T.StringType()),
    ]
)

# ---------------------------------------------------------------------------
# Manifests: what each write left in a table, by date.
# ---------------------------------------------------------------------------
FINGERPRINT = T.DecimalType(38, 0)
DAYS = T.StructType([T.StructField("date", T.DateType())])
MANIFEST = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("file", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("fingerprint", FINGERPRINT),
        T.StructField("input_rows", T.LongType()),
        T.StructField("input_fingerprint", FINGERPRINT),
        T.StructField("run_id", T.StringType()),
        T.StructField("recorded_at", T.TimestampType()),
    ]
)
# Tables whose versions two runs over one input must agree on.
FINGERPRINTED = (
    "bronze_transactions",
    "bronze_accounts",
    "silver_transactions",
    "silver_quarantine",
    "gold_partials",
)
# Columns that say when and by which run a row was written, not what it holds.
STAMPS = ("_bronze_ingested_at", "_promoted_at", "_pipeline_run_id")
# Ids of accepted transactions, by the write that accepted them.
ACCEPTED_IDS = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("judged_at", T.TimestampType()),
    ]
)

# Gold folds these: one row per transaction date and code, and one per week, account and
# code, for every processing date.
PARTIAL_MONEY = T.DecimalType(34, 6)
DAILY_PARTIALS = T.StructType(
    [
        T.StructField("transaction_date", T.DateType()),
        T.StructField("transaction_code", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("signed", PARTIAL_MONEY),
        T.StructField("online", T.LongType()),
        T.StructField("instore", T.LongType()),
        T.StructField("date", T.DateType()),
    ]
)
WEEKLY_PARTIALS = T.StructType(
    [
        T.StructField("week_start_date", T.DateType()),
        T.StructField("account_id", T.StringType()),
        T.StructField("transaction_code", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("signed", PARTIAL_MONEY),
        T.StructField("date", T.DateType()),
    ]
)
