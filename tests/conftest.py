import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pulselake.session import SETTINGS  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("pulselake-tests")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="shared-", dir="/tmp"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="warehouse-", dir="/tmp"))
    )
    for key, setting in SETTINGS.items():
        builder = builder.config(key, setting)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="pulselake-test-", dir="/tmp")
