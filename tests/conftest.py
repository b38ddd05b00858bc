from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from ledgerstrata.sources.tables import configure


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    session = (
        SparkSession.builder.master("local[4]")
        .appName("ledgerstrata-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    return configure(session)
