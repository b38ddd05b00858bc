"""A hot id in joins too large to broadcast is split over tasks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerstrata.operators.transactions import classify_transactions
from ledgerstrata.sources import tables as TB
from tests import sample
from tests.sample import D1

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    "spark.sql.shuffle.partitions": "16",
}


def test_a_hot_id_is_split(spark):
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    n = 60_000
    try:
        for name, value in SETTINGS.items():
            spark.conf.set(name, value)
        rows = spark.range(0, n, 1, 8).select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("transaction_id"),
            F.concat(F.lit("N"), "id").alias("account_id"),
            F.lit("2024-07-01").alias("transaction_date"),
            F.lit("1.00").alias("amount"),
            F.concat(F.lit("C"), F.col("id") % 50).alias("transaction_code"),
            F.sha2(F.col("id").cast("string"), 256).alias("merchant_name"),
            F.lit("ONLINE").alias("channel"),
            F.lit("f").alias("_source_file"),
            F.lit(sample.NOW).alias("_ingested_at"),
            F.lit(D1).alias("date"),
            F.col("id").alias("_row_id"),
        )
        codes = spark.range(50).select(
            F.concat(F.lit("C"), "id").alias("transaction_code"), F.lit("DR").alias("debit_credit_indicator")
        )
        def keep(part):
            return TB.keep(part, TB.shared_dir(spark, "skew"))

        frame = classify_transactions(rows, codes, keep(sample.known(spark, A=D1)), keep=keep)
        found = {r["_rejection_reason"]: r["count"] for r in frame.groupBy("_rejection_reason").count().collect()}
        # collect on the frame itself, so that its final plan can be read
        assert len(frame.select("transaction_id", "_rejection_reason").collect()) == n
        probe = frame.select("transaction_id", "merchant_name", "_rejection_reason")
        probe.collect()
        plan = probe._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
    assert found == {None: n - n // 3 + 1, "DUPLICATE_TRANSACTION_ID": n // 3 - 1}
    assert "skew=true" in plan
