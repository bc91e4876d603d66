from __future__ import annotations

import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def build_session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[*]")
        .appName("shelfcast-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.default.parallelism", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="shelfcast-warehouse-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    session = build_session()
    yield session
    session.stop()


@pytest.fixture
def path(spark):
    from shelfcast.workspace import scratch_path

    return scratch_path(spark, "test")


@pytest.fixture
def database(spark):
    from shelfcast.workspace import scratch_database

    return scratch_database(spark, "test")
