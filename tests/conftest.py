import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("siftwell-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """One-column frame ``v`` of a DDL type."""

    def make(values, ddl):
        return spark.createDataFrame([(v,) for v in values], f"v {ddl}")

    return make


@pytest.fixture
def values():
    """Values of column ``v`` in input order (frames of one partition keep it)."""

    def read(frame, name="v"):
        return [r[name] for r in frame.collect()]

    return read


@pytest.fixture
def count_jobs(spark):
    """Number of Spark jobs a function runs, and its result."""

    def run(function):
        import uuid

        group = uuid.uuid4().hex
        spark.sparkContext.setJobGroup(group, group)
        try:
            result = function()
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)), result

    return run
