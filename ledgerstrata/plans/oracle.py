"""The registered queries as plain SQL over the same test tables.

Written from the rules and in another shape than the Spark plans: duplicates are
found with windows here, with aggregates and joins there.
"""

from __future__ import annotations

from ledgerstrata import schemas as S
from ledgerstrata.sources.adapters import RUN_ID

_CODES = """codes(transaction_code, description, debit_credit_indicator, transaction_type, affects_balance) AS (
  VALUES ('PURCH01','Purchase','DR','PURCHASE',true), ('PAY01','Payment','CR','PAYMENT',true),
         ('FEE01','Annual Fee','DR','FEE',true), ('INT01','Interest Charge','DR','INTEREST',true))"""

_EVENT_CODE = """CASE event_type WHEN 'purchase' THEN 'PURCH01' WHEN 'click' THEN 'PAY01'
    WHEN 'view' THEN 'FEE01' WHEN 'signup' THEN 'INT01' ELSE 'ERR01' END"""

_EVENT_TXN = f"""txn AS (
  SELECT CAST(CASE WHEN event_id % 20 = 0 THEN event_id // 2
                   WHEN event_id % 33 = 1 THEN event_id - 1 ELSE event_id END AS VARCHAR) AS transaction_id,
         CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS account_id,
         CAST(ts AS DATE) AS transaction_date,
         CAST(CAST(value AS DECIMAL(18,2)) - 2.00 + CASE WHEN event_id % 101 = 7 THEN 0.005
              WHEN event_id % 101 = 8 THEN 0.0000005 ELSE 0 END AS DECIMAL(24,7)) AS amount,
         {_EVENT_CODE} AS transaction_code,
         CASE WHEN event_type = 'purchase' THEN 'shop-' || CAST(user_id % 50 AS VARCHAR) END AS merchant_name,
         CASE WHEN event_id % 13 = 0 THEN 'DRIVE_THRU' WHEN event_id % 3 = 0 THEN 'IN_STORE'
              ELSE 'ONLINE' END AS channel,
         event_id AS seq, CAST(ts AS DATE) AS date,
         'transactions_' || CAST(CAST(ts AS DATE) AS VARCHAR) || '.csv' AS _source_file,
         '{RUN_ID}' AS _pipeline_run_id
  FROM events)"""


def _customer(name: str, full: bool) -> str:
    limit = "CASE WHEN c_custkey % 89 = 88 THEN NULL ELSE 5000.00 END" if full else "5000.00"
    again = (
        "(SELECT *, 0 AS again FROM customer UNION ALL SELECT *, 1 FROM customer WHERE c_custkey % 4 = 0)"
        if full
        else "(SELECT *, 0 AS again FROM customer)"
    )
    return f"""{name}_rows AS (
  SELECT CAST(c_custkey AS VARCHAR) AS account_id, c_name AS customer_name,
         CASE WHEN c_acctbal < 0 THEN 'DELINQUENT' ELSE 'ACTIVE' END AS account_status,
         CAST({limit} AS DECIMAL(18,2)) AS credit_limit,
         CAST(CAST(c_acctbal AS DECIMAL(18,2)) + 100 * again AS DECIMAL(18,2)) AS current_balance,
         DATE '2020-01-01' AS open_date, DATE '2024-01-01' AS billing_cycle_start,
         DATE '2024-01-31' AS billing_cycle_end,
         DATE '2024-01-01' + CAST(c_custkey % 10 + 10 * again AS INTEGER) AS date
  FROM {again}),
{name} AS (
  SELECT *, 'accounts_' || CAST(date AS VARCHAR) || '.csv' AS _source_file, '{RUN_ID}' AS _pipeline_run_id,
         CASE WHEN credit_limit IS NULL THEN 'NULL_REQUIRED_FIELD'
              WHEN account_status NOT IN ('ACTIVE','SUSPENDED','CLOSED') THEN 'INVALID_ACCOUNT_STATUS'
         END AS _rejection_reason
  FROM {name}_rows)"""


_SUPPLIER = f"""acc AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS account_id, CAST(s_acctbal AS DECIMAL(18,2)) AS current_balance,
         DATE '1995-01-01' + CAST(s_suppkey % 1000 AS INTEGER) AS date,
         CASE WHEN s_acctbal < 0 THEN 'INVALID_ACCOUNT_STATUS' END AS _rejection_reason
  FROM supplier)"""

_LINEITEM_TXN = f"""txn AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS transaction_id,
         CAST(l_suppkey AS VARCHAR) AS account_id, CAST(l_shipdate AS DATE) AS transaction_date,
         CAST(l_extendedprice AS DECIMAL(18,2)) - 3000.00 AS amount,
         CASE l_returnflag WHEN 'A' THEN 'PURCH01' WHEN 'R' THEN 'PAY01' ELSE 'FEE01' END AS transaction_code,
         CASE WHEN l_quantity = 50 THEN 'DRIVE_THRU' WHEN l_linestatus = 'O' THEN 'ONLINE'
              ELSE 'IN_STORE' END AS channel,
         ROW_NUMBER() OVER (ORDER BY l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey,
                            l_extendedprice) AS seq,
         CAST(l_shipdate AS DATE) AS date
  FROM lineitem)"""

_KNOWN = """known AS (
  SELECT account_id, MIN(date) AS known_from FROM acc WHERE _rejection_reason IS NULL GROUP BY account_id),
snapshot AS (
  SELECT * FROM acc WHERE _rejection_reason IS NULL
  QUALIFY ROW_NUMBER() OVER (PARTITION BY account_id ORDER BY date DESC) = 1)"""


def _classified(order: str) -> str:
    return f"""screened AS (
  SELECT t.*, c.debit_credit_indicator AS _indicator,
         CASE WHEN transaction_id IS NULL OR account_id IS NULL THEN 'NULL_REQUIRED_FIELD'
              WHEN amount <= 0 OR amount <> CAST(amount AS DECIMAL(24,6)) THEN 'INVALID_AMOUNT' END AS r12,
         CASE WHEN c.transaction_code IS NULL THEN 'INVALID_TRANSACTION_CODE'
              WHEN channel NOT IN ('ONLINE','IN_STORE') THEN 'INVALID_CHANNEL' END AS r45
  FROM txn t LEFT JOIN codes c ON t.transaction_code = c.transaction_code),
ranked AS (
  SELECT *, MIN(CASE WHEN r12 IS NULL AND r45 IS NULL THEN date END)
              OVER (PARTITION BY transaction_id) AS first_ok,
         ROW_NUMBER() OVER (PARTITION BY transaction_id, date, (r12 IS NULL AND r45 IS NULL)
                            ORDER BY {order}) AS rn
  FROM screened),
classified AS (
  SELECT r.*, COALESCE(k.known_from <= r.date, false) AS _is_resolvable, k.known_from <= r.date AS maybe_known,
         COALESCE(r12, CASE WHEN first_ok < r.date THEN 'DUPLICATE_TRANSACTION_ID' END, r45,
                  CASE WHEN rn > 1 THEN 'DUPLICATE_TRANSACTION_ID' END) AS _rejection_reason
  FROM ranked r LEFT JOIN known k ON r.account_id = k.account_id),
silver AS (
  SELECT * REPLACE (CAST(amount AS DECIMAL(24,6)) AS amount),
         CAST(CASE WHEN _indicator = 'DR' THEN amount ELSE -amount END AS DECIMAL(24,6)) AS _signed_amount
  FROM classified WHERE _rejection_reason IS NULL),
rejects AS (SELECT * FROM classified WHERE _rejection_reason IS NOT NULL)"""


def _daily(name: str, source: str, flag: str = "_is_resolvable") -> str:
    parts = []
    for kind in S.TRANSACTION_TYPES:
        match = f"FILTER (WHERE {flag} AND transaction_type = '{kind}')"
        parts.append(f"CAST(COUNT(*) {match} AS BIGINT) AS {kind.lower()}_count")
        parts.append(
            f"CAST(COALESCE(SUM(_signed_amount) {match}, 0) AS DECIMAL(18,3)) AS {kind.lower()}_sum"
        )
    return f"""{name} AS (
  SELECT transaction_date, CAST(COUNT(*) FILTER (WHERE {flag}) AS BIGINT) AS total_transactions,
         CAST(COALESCE(SUM(_signed_amount) FILTER (WHERE {flag}), 0) AS DECIMAL(18,3)) AS total_signed_amount,
         {", ".join(parts)},
         CAST(COUNT(*) FILTER (WHERE {flag} AND channel = 'ONLINE') AS BIGINT) AS online_transactions,
         CAST(COUNT(*) FILTER (WHERE {flag} AND channel = 'IN_STORE') AS BIGINT) AS instore_transactions
  FROM {source} s LEFT JOIN codes c ON s.transaction_code = c.transaction_code
  GROUP BY transaction_date)"""


def _weekly(name: str, source: str) -> str:
    def money(kind: str) -> str:
        return f"CAST(COALESCE(SUM(_signed_amount) FILTER (WHERE transaction_type = '{kind}'), 0) AS DECIMAL(18,3))"

    bought = "FILTER (WHERE transaction_type = 'PURCHASE')"
    # The mean in whole thousandths, half up, without leaving exact numbers.
    mean = f"""CASE WHEN COUNT(*) {bought} > 0 THEN CAST(CAST(
        (CAST(SUM(_signed_amount) {bought} * 1000000 AS BIGINT) * 2 + 1000 * COUNT(*) {bought})
        // (2000 * COUNT(*) {bought}) AS DECIMAL(15,0)) * 0.001 AS DECIMAL(18,3)) END"""
    return f"""{name} AS (
  SELECT CAST(DATE_TRUNC('week', transaction_date) AS DATE) AS week_start_date,
         CAST(DATE_TRUNC('week', transaction_date) AS DATE) + 6 AS week_end_date, account_id,
         CAST(COUNT(*) {bought} AS BIGINT) AS total_purchases, {mean} AS avg_purchase_amount,
         {money('PAYMENT')} AS total_payments, {money('FEE')} AS total_fees,
         {money('INTEREST')} AS total_interest
  FROM {source} s LEFT JOIN codes c ON s.transaction_code = c.transaction_code
  WHERE _is_resolvable GROUP BY ALL)"""


_LOG = """days AS (SELECT CAST(ts AS DATE) AS d, COUNT(*) AS n FROM events GROUP BY 1),
models(model, layer, step) AS (
  VALUES ('bronze_accounts','BRONZE',1), ('bronze_transactions','BRONZE',2), ('silver_accounts','SILVER',3),
         ('silver_transactions','SILVER',4), ('gold_daily_summary','GOLD',5),
         ('gold_weekly_account_summary','GOLD',6)),
attempts AS (
  SELECT d, n, model, layer, step, attempt, DAY(d) % 7 = 3 AND model = 'silver_transactions' AS shaky
  FROM days, models, (VALUES (1), (2)) a(attempt)
  WHERE attempt = 1 OR (DAY(d) % 7 = 3 AND model = 'silver_transactions' AND DAY(d) < 24)),
log AS (
  SELECT 'run-' || CAST(d AS VARCHAR) || '-' || CAST(attempt AS VARCHAR) AS run_id,
         'HISTORICAL' AS pipeline_type, model AS model_name, layer, d AS processing_date,
         CAST((d - DATE '1970-01-01') * 86400 + attempt * 3600 + step * 60
           - CASE WHEN DAY(d) = 27 AND model = 'silver_accounts' THEN 7200 ELSE 0 END AS BIGINT) AS started_at,
         CAST((d - DATE '1970-01-01') * 86400 + attempt * 3600 + step * 60 + 30
           - CASE WHEN DAY(d) = 27 AND model = 'silver_accounts' THEN 7200 ELSE 0 END AS BIGINT) AS completed_at,
         CASE WHEN shaky AND attempt = 1 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
         n AS records_processed, CASE WHEN shaky AND attempt = 1 THEN NULL ELSE n END AS records_written,
         CAST(NULL AS BIGINT) AS records_rejected,
         CASE WHEN shaky AND attempt = 1 THEN 'cannot read <path> ' || CAST(n AS VARCHAR) || ' rows'
         END AS error_message
  FROM attempts),
latest AS (
  SELECT * FROM log QUALIFY ROW_NUMBER() OVER (PARTITION BY model_name, processing_date
                                               ORDER BY completed_at DESC) = 1),
ready AS (
  SELECT processing_date,
         COALESCE(MAX(completed_at) FILTER (WHERE model_name = 'silver_accounts' AND status = 'SUCCESS')
               >= MAX(completed_at) FILTER (WHERE model_name = 'bronze_accounts'
                                              AND status IN ('SUCCESS','SKIPPED')), false) AS accounts_ready
  FROM log GROUP BY processing_date),
open_days AS (
  SELECT processing_date FROM latest
  WHERE model_name IN ('silver_transactions','gold_daily_summary','gold_weekly_account_summary')
  GROUP BY processing_date HAVING COUNT(*) FILTER (WHERE status = 'SUCCESS') < 3),
mark AS (
  SELECT COALESCE((SELECT MIN(processing_date) FROM open_days) - 1, MAX(d)) AS last_processed_date FROM days)"""

_STALE = "DATE '2024-01-20'"
_MONEY_SUM = "CAST(SUM(total_signed_amount) AS DECIMAL(38,3))"

# Pieces the checks compare, in the order they build on each other.
_DERIVED = f"""event_codes AS (
  SELECT * FROM codes WHERE transaction_code IN (SELECT {_EVENT_CODE} FROM events)),
unsigned AS (
  SELECT * EXCLUDE (_pipeline_run_id, _is_resolvable), maybe_known AS _is_resolvable,
         CASE _indicator WHEN 'DR' THEN amount WHEN 'CR' THEN -amount END AS _signed_amount,
         CASE WHEN account_id IS NOT NULL THEN '{RUN_ID}' END AS _pipeline_run_id
  FROM classified),
stale AS (SELECT * FROM silver WHERE transaction_date <= {_STALE}),
online AS (SELECT * FROM silver WHERE channel = 'ONLINE'),
{_daily('daily', 'silver')},
{_daily('stale_daily', 'stale')},
{_daily('generous_daily', 'silver', 'true')},
{_weekly('weekly', 'silver')},
{_weekly('stale_weekly', 'stale')},
{_weekly('online_weekly', 'online')},
recon AS (
  SELECT date, COUNT(*) AS bronze_rows, COUNT(*) FILTER (WHERE _rejection_reason IS NULL) AS silver_rows,
         COUNT(*) FILTER (WHERE _rejection_reason IS NOT NULL) AS quarantine_rows,
         CAST(0 AS BIGINT) AS delta
  FROM classified GROUP BY date),
leaky AS (
  SELECT date, COUNT(*) AS bronze_rows, COUNT(*) FILTER (WHERE _rejection_reason IS NULL) AS silver_rows,
         COUNT(*) FILTER (WHERE _rejection_reason <> 'INVALID_CHANNEL') AS quarantine_rows,
         COUNT(*) FILTER (WHERE _rejection_reason = 'INVALID_CHANNEL') AS delta
  FROM classified GROUP BY date),
gate AS (
  SELECT date FROM classified GROUP BY date
  HAVING COUNT(*) FILTER (WHERE _rejection_reason = 'DUPLICATE_TRANSACTION_ID') = 0 OR DAY(date) % 2 = 0),
gated AS (SELECT * FROM silver WHERE date IN (SELECT date FROM gate)),
{_daily('gated_daily', 'gated')},
dirty_acc AS (
  SELECT * REPLACE (CASE WHEN _rejection_reason IS NULL THEN _pipeline_run_id END AS _pipeline_run_id),
         account_status = 'ACTIVE' AS has_valid_from
  FROM acc_full),
shifted AS (
  SELECT DISTINCT transaction_date AS week_start_date,
         CAST(DATE_TRUNC('week', transaction_date) AS DATE) + 6 AS week_end_date, account_id
  FROM silver WHERE _is_resolvable)"""

_BASE = f"{_CODES},\n{_EVENT_TXN},\n{_customer('acc', False)},\n{_customer('acc_full', True)},\n{_KNOWN}"
_EVENTS = f"WITH {_BASE},\n{_classified('seq')},\n{_DERIVED},\n{_LOG}\n"
_TEXT_ORDER = (
    "account_id, transaction_date, CAST(amount AS VARCHAR), transaction_code, "
    "merchant_name NULLS FIRST, channel"
)
_LAKE = f"WITH {_BASE},\n{_classified(_TEXT_ORDER)},\n{_DERIVED},\n{_LOG}\n"
_LINEITEM = (
    f"WITH {_CODES},\n{_LINEITEM_TXN},\n{_SUPPLIER},\n{_KNOWN},\n{_classified('seq')},\n"
    f"{_daily('daily', 'silver')},\n{_weekly('weekly', 'silver')}\n"
)


# A day's extract that had only some of its rows when it was first loaded: the rest of its
# rows come in when all other days are taken.
_LATE_DAY = "DATE '2024-01-11'"
_REGROWN = f"""WITH {_BASE.replace("txn AS (", "whole AS (", 1)},
txn AS (SELECT * FROM whole WHERE date <> {_LATE_DAY} OR seq % 10 > 0),
{_classified(_TEXT_ORDER)},
{_DERIVED},
again AS (
  SELECT w.*, c.debit_credit_indicator AS _indicator, COALESCE(k.known_from <= w.date, false) AS _is_resolvable,
         CASE WHEN w.transaction_id IS NULL OR w.account_id IS NULL THEN 'NULL_REQUIRED_FIELD'
              WHEN amount <= 0 OR amount <> CAST(amount AS DECIMAL(24,6)) THEN 'INVALID_AMOUNT'
              WHEN w.transaction_id IN (SELECT s.transaction_id FROM silver s WHERE s.date <> {_LATE_DAY})
                THEN 'DUPLICATE_TRANSACTION_ID'
              WHEN c.transaction_code IS NULL THEN 'INVALID_TRANSACTION_CODE'
              WHEN channel NOT IN ('ONLINE','IN_STORE') THEN 'INVALID_CHANNEL' END AS reason
  FROM whole w LEFT JOIN codes c ON w.transaction_code = c.transaction_code
  LEFT JOIN known k ON w.account_id = k.account_id WHERE w.date = {_LATE_DAY}),
ruled AS (
  SELECT *, reason IS NULL AND ROW_NUMBER() OVER (PARTITION BY transaction_id, reason IS NULL ORDER BY {_TEXT_ORDER}) = 1 AS taken
  FROM again),
regrown AS (
  SELECT transaction_date, transaction_code, channel, _is_resolvable, _signed_amount FROM silver WHERE date <> {_LATE_DAY}
  UNION ALL
  SELECT transaction_date, transaction_code, channel, _is_resolvable,
         CAST(CASE WHEN _indicator = 'DR' THEN amount ELSE -amount END AS DECIMAL(24,6)) FROM ruled WHERE taken),
{_daily('regrown_daily', 'regrown')},
regrown_recon AS (
  SELECT * FROM recon WHERE date <> {_LATE_DAY}
  UNION ALL
  SELECT date, COUNT(*), COUNT(*) FILTER (WHERE taken), COUNT(*) FILTER (WHERE NOT taken), CAST(0 AS BIGINT)
  FROM ruled GROUP BY date)
"""

_SOURCE = ", ".join(S.TRANSACTION_SOURCE.names)
_SOURCE_TEXT = (
    "transaction_id, account_id, CAST(transaction_date AS VARCHAR) AS transaction_date, "
    "CAST(amount AS VARCHAR) AS amount, transaction_code, merchant_name, channel"
)
_ACCOUNT_TEXT = ", ".join(f"CAST({n} AS VARCHAR) AS {n}" for n in S.ACCOUNT_SOURCE.names)
_ACCOUNT = ", ".join(S.ACCOUNT_SOURCE.names)
_AUDIT = "_source_file, _pipeline_run_id"
_VERDICT = "transaction_id, account_id, date, amount, transaction_code, channel, _is_resolvable, _rejection_reason"
_SILVER = f"{_SOURCE}, _source_file, _is_resolvable, _signed_amount, _pipeline_run_id, date"
_CODE_COLUMNS = "transaction_code, description, debit_credit_indicator, transaction_type, affects_balance"


def _metrics(daily: str, weekly: str) -> str:
    counts = {
        "bronze_transactions": "txn",
        "bronze_accounts": "acc",
        "bronze_transaction_codes": "event_codes",
        "silver_transactions": "silver",
        "silver_accounts": "snapshot",
        "quarantine": "rejects",
        "gold_daily_summary": daily,
        "gold_weekly_account_summary": weekly,
    }
    parts = [
        f"SELECT '{metric}' AS metric, CAST(COUNT(*) AS DECIMAL(38,3)) AS value FROM {table}"
        for metric, table in counts.items()
    ]
    parts.append(f"SELECT 'gold_daily_signed_sum', {_MONEY_SUM} FROM {daily}")
    parts.append(
        "SELECT 'watermark', CAST(last_processed_date - DATE '1970-01-01' AS DECIMAL(38,3)) FROM mark"
    )
    return " UNION ALL ".join(parts)


_DIFF = f"""SELECT a.metric, a.value AS first_value, b.value AS second_value
  FROM ({_metrics('daily', 'weekly')}) a JOIN ({_metrics('stale_daily', 'stale_weekly')}) b ON a.metric = b.metric
  WHERE a.value IS DISTINCT FROM b.value"""

_ORACLE: dict[str, tuple[str, str]] = {
    "bronze_transactions": (_EVENTS, f"SELECT {_SOURCE_TEXT}, {_AUDIT}, date FROM txn"),
    "bronze_accounts": (_EVENTS, f"SELECT {_ACCOUNT_TEXT}, {_AUDIT}, date FROM acc_full"),
    "bronze_transaction_codes": (
        _EVENTS,
        f"""SELECT * REPLACE (CAST(affects_balance AS VARCHAR) AS affects_balance),
              'transaction_codes.csv' AS _source_file, '{RUN_ID}' AS _pipeline_run_id FROM event_codes""",
    ),
    "source_counts": (
        _EVENTS,
        "SELECT date, _source_file, COUNT(*) AS source_rows FROM txn GROUP BY ALL",
    ),
    "scan_partitioned": (_EVENTS, f"SELECT {_SILVER} FROM silver"),
    "scan_one_partition": (_EVENTS, f"SELECT {_SILVER} FROM silver WHERE date = {_STALE}"),
    "missing_dates": (
        _EVENTS,
        """SELECT CAST(day AS DATE) AS date FROM (
             SELECT UNNEST(generate_series(MIN(date) - 3, MAX(date) + 2, INTERVAL 1 DAY)) AS day FROM txn)
           WHERE CAST(day AS DATE) NOT IN (SELECT date FROM txn)""",
    ),
    "bronze_load_plan": (
        _EVENTS,
        """SELECT date, source_rows, CASE WHEN DAY(date) IN (2, 3, 5, 7) THEN NULL WHEN DAY(date) = 9 THEN found
                    ELSE source_rows END AS bronze_rows,
                  CASE WHEN DAY(date) = 2 THEN 'WRITE' WHEN DAY(date) IN (3, 5, 7) OR found <> source_rows AND DAY(date) = 9
                    THEN 'REWRITE' ELSE 'SKIP' END AS action
           FROM (SELECT date, COUNT(*) AS source_rows, COUNT(*) FILTER (seq % 10 > 0) AS found FROM txn GROUP BY date)""",
    ),
    "silver_transaction_codes": (
        _EVENTS,
        f"""SELECT {_CODE_COLUMNS}, 'transaction_codes.csv' AS _source_file,
              '{RUN_ID}' AS _pipeline_run_id FROM event_codes""",
    ),
    "accounts_classified": (_EVENTS, f"SELECT {_ACCOUNT}, {_AUDIT}, date, _rejection_reason FROM acc_full"),
    "silver_accounts": (
        _EVENTS,
        f"""SELECT {_ACCOUNT}, {_AUDIT} FROM acc_full WHERE _rejection_reason IS NULL
            QUALIFY ROW_NUMBER() OVER (PARTITION BY account_id ORDER BY date DESC) = 1""",
    ),
    "accounts_upsert": (
        _EVENTS,
        """SELECT account_id, current_balance, date FROM acc_full WHERE _rejection_reason IS NULL
           QUALIFY ROW_NUMBER() OVER (PARTITION BY account_id ORDER BY date DESC) = 1""",
    ),
    "transactions_classified": (_EVENTS, f"SELECT seq, {_VERDICT} FROM classified"),
    "transactions_classified_rerun": (
        _EVENTS,
        f"SELECT seq, {_VERDICT} FROM classified WHERE date > {_STALE}",
    ),
    "silver_transactions": (_EVENTS, f"SELECT {_SILVER} FROM silver"),
    "quarantine_transactions": (
        _EVENTS,
        f"SELECT {_SOURCE_TEXT}, {_AUDIT}, date, _rejection_reason FROM rejects",
    ),
    "quarantine_accounts": (
        _EVENTS,
        f"""SELECT {_ACCOUNT}, {_AUDIT}, date, _rejection_reason FROM acc_full
            WHERE _rejection_reason IS NOT NULL""",
    ),
    "quarantine_all": (
        _EVENTS,
        f"""SELECT {_SOURCE_TEXT}, {_AUDIT}, date, _rejection_reason, 'transactions' AS entity FROM rejects
            UNION ALL BY NAME
            SELECT {_ACCOUNT}, {_AUDIT}, date, _rejection_reason, 'accounts' AS entity FROM acc_full
            WHERE _rejection_reason IS NOT NULL""",
    ),
    "rejection_summary": (
        _EVENTS,
        "SELECT date, _rejection_reason, COUNT(*) AS rejected_rows FROM rejects GROUP BY ALL",
    ),
    "rejection_summary_accounts": (
        _EVENTS,
        """SELECT date, _rejection_reason, COUNT(*) AS rejected_rows FROM acc_full
           WHERE _rejection_reason IS NOT NULL GROUP BY ALL""",
    ),
    "gold_daily_summary": (
        _EVENTS,
        f"""SELECT *, '{RUN_ID}' AS _pipeline_run_id,
              (SELECT MIN(transaction_date) FROM silver) AS _source_period_start,
              (SELECT MAX(transaction_date) FROM silver) AS _source_period_end FROM daily""",
    ),
    "gold_weekly_account_summary": (
        _EVENTS,
        f"""SELECT w.*, CAST(s.current_balance AS DECIMAL(18,3)) AS closing_balance,
              '{RUN_ID}' AS _pipeline_run_id
            FROM weekly w LEFT JOIN snapshot s ON w.account_id = s.account_id""",
    ),
    "transactions_classified_lineitem": (_LINEITEM, f"SELECT {_VERDICT} FROM classified"),
    "rejection_summary_lineitem": (
        _LINEITEM,
        "SELECT date, _rejection_reason, COUNT(*) AS rejected_rows FROM rejects GROUP BY ALL",
    ),
    "gold_daily_summary_lineitem": (_LINEITEM, "SELECT * FROM daily"),
    "gold_weekly_account_summary_lineitem": (
        _LINEITEM,
        f"""SELECT w.*, CAST(s.current_balance AS DECIMAL(18,3)) AS closing_balance,
              '{RUN_ID}' AS _pipeline_run_id
            FROM weekly w LEFT JOIN snapshot s ON w.account_id = s.account_id""",
    ),
    "reconciliation": (_EVENTS, "SELECT * FROM recon"),
    "reconciliation_total": (
        _EVENTS,
        """SELECT CAST(SUM(bronze_rows) AS BIGINT) AS bronze_rows, CAST(SUM(silver_rows) AS BIGINT) AS silver_rows,
                  CAST(SUM(quarantine_rows) AS BIGINT) AS quarantine_rows, CAST(SUM(delta) AS BIGINT) AS delta
           FROM leaky""",
    ),
    "promotion_gate": (_EVENTS, "SELECT date FROM gate"),
    "promotion_gate_daily": (_EVENTS, "SELECT * FROM gated_daily"),
    "layer_metrics": (_EVENTS, _metrics("daily", "weekly")),
    "idempotency_diff": (_EVENTS, _DIFF),
    "run_log": (_EVENTS, "SELECT * FROM log"),
    "run_log_latest": (_EVENTS, "SELECT * EXCLUDE (error_message) FROM latest"),
    "run_log_sanitized": (
        _EVENTS,
        "SELECT run_id, model_name, error_message FROM log WHERE error_message IS NOT NULL",
    ),
    "accounts_ready": (_EVENTS, "SELECT * FROM ready"),
    "watermark": (_EVENTS, f"SELECT last_processed_date, '{RUN_ID}' AS updated_by_run_id FROM mark"),
    "next_date": (_EVENTS, "SELECT last_processed_date + 1 AS next_date FROM mark"),
    "scalar_functions": (
        _EVENTS,
        """SELECT seq, CAST(DATE_TRUNC('week', transaction_date) AS DATE) AS week_start,
                  CAST(DATE_TRUNC('week', transaction_date) AS DATE) + 6 AS week_end,
                  EXTRACT(DOW FROM transaction_date) = 1 AS is_monday, channel AS trimmed,
                  COALESCE(account_id, 'none') AS account_or_none, ABS(amount) AS abs_amount,
                  CAST(amount AS DECIMAL(18,3)) AS gold_amount,
                  CASE WHEN channel = 'ONLINE' THEN amount ELSE -amount END AS signed,
                  date AS file_date, 'lost <path> again' AS scrubbed
           FROM txn""",
    ),
    "historical_run": (
        _LAKE,
        """SELECT r.*, d.total_transactions, d.total_signed_amount, (SELECT MAX(date) FROM txn) AS watermark
           FROM recon r LEFT JOIN daily d ON r.date = d.transaction_date""",
    ),
    "incremental_run": (
        _LAKE,
        """SELECT r.*, d.total_transactions, d.total_signed_amount, (SELECT MAX(date) FROM txn) AS watermark
           FROM recon r LEFT JOIN daily d ON r.date = d.transaction_date""",
    ),
    "regrown_extract_run": (
        _REGROWN,
        """SELECT r.*, d.total_transactions, d.total_signed_amount, (SELECT MAX(date) FROM txn) AS watermark
           FROM regrown_recon r LEFT JOIN regrown_daily d ON r.date = d.transaction_date""",
    ),
    "run_log_compacted": (_EVENTS, "SELECT * FROM log"),
    "scan_absent": (
        _EVENTS,
        "SELECT date, COUNT(*) AS stored_rows, CAST(0 AS BIGINT) AS absent_rows FROM silver GROUP BY date",
    ),
    "gold_daily_written_order": (
        _EVENTS,
        "SELECT transaction_date, ROW_NUMBER() OVER (ORDER BY transaction_date) AS place FROM daily",
    ),
    "run_log_order": (
        _EVENTS,
        "SELECT run_id, model_name, ROW_NUMBER() OVER (ORDER BY started_at) AS place FROM log",
    ),
    "iso_days": (
        _EVENTS,
        """SELECT seq, text, regexp_full_match(text, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND TRY_CAST(text AS DATE) IS NOT NULL AS is_day
           FROM (SELECT seq, CASE seq % 5 WHEN 0 THEN substr(CAST(date AS VARCHAR), 1, 4)
                   WHEN 1 THEN substr(CAST(date AS VARCHAR), 1, 7) WHEN 2 THEN CAST(date AS VARCHAR) || 'T00'
                   WHEN 3 THEN replace(CAST(date AS VARCHAR), '-01-', '-13-') ELSE CAST(date AS VARCHAR) END AS text FROM txn)""",
    ),
    "reconciliation_lost_partition": (
        _EVENTS,
        f"""SELECT date, bronze_rows, CASE WHEN date = {_STALE} THEN 0 ELSE silver_rows END AS silver_rows,
                   quarantine_rows, CASE WHEN date = {_STALE} THEN silver_rows ELSE 0 END AS delta FROM recon""",
    ),
    "idempotency_content_diff": (
        _EVENTS,
        """SELECT 'silver_transactions' AS table_name, date, COUNT(*) AS first_rows, COUNT(*) AS second_rows
           FROM silver WHERE date = (SELECT date FROM silver ORDER BY transaction_id LIMIT 1) GROUP BY date""",
    ),
    "gold_daily_from_partials": (_EVENTS, "SELECT * FROM daily"),
    "gold_weekly_from_partials": (_EVENTS, "SELECT * FROM weekly"),
    "gold_spine_mismatch": (
        _EVENTS,
        """SELECT DISTINCT transaction_date, 'MISSING_IN_GOLD' AS mismatch FROM silver
           WHERE transaction_date NOT IN (SELECT transaction_date FROM stale_daily)""",
    ),
}

_EXPECTED_WEEKLY = """SELECT account_id, CAST(DATE_TRUNC('week', transaction_date) AS DATE) AS week_start_date,
         COUNT(*) FILTER (WHERE transaction_type = 'PURCHASE') AS n
  FROM silver JOIN codes USING (transaction_code)
  WHERE _is_resolvable GROUP BY ALL"""
_DAILY_PAIR = "generous_daily g JOIN daily d ON g.transaction_date = d.transaction_date"
_DONE = "SELECT run_id FROM log WHERE status = 'SUCCESS' AND model_name ="
_RUN_1, _RUN_2 = "'run-' || CAST(date AS VARCHAR) || '-1'", "'run-' || CAST(date AS VARCHAR) || '-2'"

# Number of violations of each check on the inputs the registry hands it.
_VIOLATIONS: dict[str, str] = {
    "B-01": """SELECT COUNT(*) FROM (SELECT date FROM txn GROUP BY date
                 HAVING COUNT(*) <> COUNT(DISTINCT COALESCE(transaction_id, '')))""",
    "B-02": """SELECT COUNT(*) FROM (SELECT date, COUNT(*) AS n FROM acc_full GROUP BY date) f
               FULL JOIN (SELECT date, COUNT(*) AS n FROM acc GROUP BY date) a ON f.date = a.date
               WHERE f.n IS DISTINCT FROM a.n""",
    "B-03": """SELECT ABS((SELECT COUNT(DISTINCT event_type) FROM events) - (SELECT COUNT(*) FROM event_codes))""",
    "B-04": """SELECT (SELECT COUNT(*) FROM txn WHERE account_id IS NULL)
                    + (SELECT COUNT(*) FROM acc WHERE account_status <> 'ACTIVE')""",
    "B-05": "SELECT COUNT(*) FROM txn WHERE amount < 0",
    "ST-01": "SELECT COUNT(*) FROM (SELECT transaction_id FROM txn GROUP BY 1 HAVING COUNT(*) > 1)",
    "ST-02": "SELECT COUNT(*) FROM unsigned WHERE _signed_amount IS NULL",
    "ST-03": "SELECT COUNT(*) FROM unsigned WHERE _is_resolvable IS NULL",
    "ST-04": "SELECT COUNT(*) FROM leaky WHERE delta <> 0",
    "ST-05": "SELECT COUNT(*) FROM classified WHERE _rejection_reason IS NULL",
    "ST-06": "SELECT COUNT(*) FROM silver WHERE NOT _is_resolvable",
    "ST-07": f"""SELECT COUNT(DISTINCT run) FROM (SELECT {_RUN_1} AS run FROM silver)
                 WHERE run NOT IN ({_DONE} 'silver_transactions')""",
    "ST-08": "SELECT COUNT(*) FROM txn WHERE transaction_code = 'ERR01'",
    "ST-09": "SELECT ABS(SUM(delta)) FROM leaky",
    "SA-01": "SELECT COUNT(*) FROM (SELECT account_id FROM acc_full GROUP BY 1 HAVING COUNT(*) > 1)",
    "SA-02": "SELECT COUNT(*) FROM dirty_acc WHERE _pipeline_run_id IS NULL",
    "SA-03": "SELECT COUNT(*) FROM dirty_acc WHERE NOT has_valid_from",
    "SA-04": "SELECT COUNT(*) FROM acc_full WHERE account_status NOT IN ('ACTIVE','SUSPENDED','CLOSED')",
    "SA-05": "SELECT COUNT(*) FROM acc_full WHERE _rejection_reason IS NULL",
    "SA-06": """SELECT COUNT(*) FROM classified WHERE _rejection_reason IS NULL
                OR _rejection_reason NOT IN ('NULL_REQUIRED_FIELD','INVALID_ACCOUNT_STATUS')""",
    "G-01": """SELECT COUNT(DISTINCT transaction_date) FROM silver
               WHERE transaction_date NOT IN (SELECT transaction_date FROM stale_daily)""",
    "G-02": f"SELECT COUNT(*) FROM {_DAILY_PAIR} WHERE g.total_transactions <> d.total_transactions",
    "G-03": f"""SELECT COUNT(*) FROM {_DAILY_PAIR}
                WHERE ABS(g.total_signed_amount - d.total_signed_amount) > 0.001""",
    "G-04": f"""SELECT COUNT(*) FROM online_weekly w FULL JOIN ({_EXPECTED_WEEKLY}) s
                ON w.account_id = s.account_id AND w.week_start_date = s.week_start_date
                WHERE w.total_purchases IS DISTINCT FROM s.n""",
    "G-05": "SELECT COUNT(*) FROM shifted WHERE EXTRACT(DOW FROM week_start_date) <> 1",
    "G-06": "SELECT COUNT(*) FROM shifted WHERE week_end_date <> week_start_date + 6",
    "G-07": """SELECT (SELECT COUNT(*) FROM daily WHERE total_transactions <= 100)
                    + (SELECT COUNT(*) FROM weekly WHERE total_purchases = 0)""",
    "I-01": f"SELECT COUNT(*) FROM ({_DIFF})",
    "AT-01": """SELECT CASE WHEN last_processed_date = (SELECT MAX(processing_date) FROM log) THEN 0 ELSE 1 END
                FROM mark""",
    "AT-02": f"""SELECT COUNT(DISTINCT run) FROM (
                   SELECT {_RUN_1} AS run FROM txn WHERE {_RUN_1} NOT IN ({_DONE} 'bronze_transactions')
                   UNION ALL SELECT {_RUN_2} FROM acc WHERE {_RUN_2} NOT IN ({_DONE} 'bronze_accounts')
                   UNION ALL SELECT '{RUN_ID}')""",
    "AT-03": f"""SELECT COUNT(DISTINCT run) FROM (
                   SELECT 'run-' || CAST(transaction_date AS VARCHAR) || '-1' AS run FROM daily
                   WHERE run NOT IN ({_DONE} 'gold_daily_summary')
                   UNION ALL SELECT '{RUN_ID}' FROM weekly)""",
    "OR-01": """SELECT COUNT(DISTINCT date) FROM txn
                WHERE date NOT IN (SELECT processing_date FROM ready WHERE accounts_ready)""",
    "TC-01": """SELECT COUNT(DISTINCT transaction_code) FROM txn
                WHERE transaction_code NOT IN (SELECT transaction_code FROM codes)""",
}


def _nulls(table: str, column: str, source: str) -> tuple[str, str]:
    return (
        f"DT-{table}-{column}-not_null",
        f"SELECT COUNT(*) FROM {source} WHERE {column} IS NULL",
    )


def _repeats(table: str, column: str, source: str) -> tuple[str, str]:
    return (
        f"DT-{table}-{column}-unique",
        f"""SELECT COUNT(*) FROM (SELECT {column} FROM {source} WHERE {column} IS NOT NULL
              GROUP BY 1 HAVING COUNT(*) > 1)""",
    )


_DECLARED = dict(
    [
        _nulls("silver_transaction_codes", "transaction_code", "txn"),
        _nulls("silver_transaction_codes", "_pipeline_run_id", "txn"),
        _nulls("silver_accounts", "account_id", "dirty_acc"),
        _nulls("silver_accounts", "_pipeline_run_id", "dirty_acc"),
        _nulls("silver_transactions", "transaction_id", "unsigned"),
        _nulls("silver_transactions", "_signed_amount", "unsigned"),
        _nulls("silver_transactions", "_pipeline_run_id", "unsigned"),
        _nulls("silver_transactions", "_is_resolvable", "unsigned"),
        _nulls("gold_daily_summary", "transaction_date", "silver"),
        _nulls("gold_daily_summary", "_pipeline_run_id", "silver"),
        _nulls("gold_weekly_account_summary", "week_start_date", "any_weekly"),
        _nulls("gold_weekly_account_summary", "account_id", "any_weekly"),
        _nulls("gold_weekly_account_summary", "_pipeline_run_id", "any_weekly"),
        _repeats("silver_transaction_codes", "transaction_code", "txn"),
        _repeats("silver_accounts", "account_id", "dirty_acc"),
        _repeats("gold_daily_summary", "transaction_date", "silver"),
    ]
)
_ANY_WEEKLY = f""", any_weekly AS (
  SELECT DATE_TRUNC('week', transaction_date) AS week_start_date, account_id,
         CASE WHEN COUNT(*) FILTER (WHERE transaction_type = 'PURCHASE') > 0 THEN '{RUN_ID}' END AS _pipeline_run_id
  FROM unsigned u LEFT JOIN codes c ON u.transaction_code = c.transaction_code GROUP BY 1, 2)
"""


def _report(counts: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS check_id, CAST(({sql}) AS BIGINT) AS violations" for name, sql in counts.items()
    )


def oracle_sql() -> dict[str, str]:
    statements = {name: prefix + body for name, (prefix, body) in _ORACLE.items()}
    for check_id, sql in _VIOLATIONS.items():
        key = "check_" + check_id.replace("-", "").lower()
        statements[key] = _EVENTS + _report({check_id: sql})
    statements["check_declared"] = _EVENTS + _ANY_WEEKLY + _report(_DECLARED)
    statements["check_all"] = _EVENTS + _ANY_WEEKLY + _report(_VIOLATIONS | _DECLARED)
    return statements
