import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__  # noqa: E402, F401  (functions travel to workers by value)


def pytest_configure(config):
    """Cases are Columns, which need a session when they are collected."""
    config.spark = _session()


@pytest.fixture(scope="session")
def spark(pytestconfig):
    return pytestconfig.spark


def _session() -> SparkSession:
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session
