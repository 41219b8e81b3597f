from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # a session zone unlike UTC and unlike the data's zone: results must not depend on it
    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "America/New_York")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def ntz(spark):
    """DataFrame from rows whose listed columns are timestamp or date text."""
    def make(rows, columns, stamps=(), dates=()):
        df = spark.createDataFrame(rows, columns)
        for c in stamps:
            df = df.withColumn(c, df[c].cast("timestamp_ntz"))
        for c in dates:
            df = df.withColumn(c, df[c].cast("date"))
        return df

    return make
