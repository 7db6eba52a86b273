import os

import pytest

import __spark_entry__ as entry_point
from oracle_check import connect, differences
from siftwell.catalog import ORACLES, QUERIES
from siftwell.operators.profile import profile

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    """Same rows as the SQL, by a plan without Python on executors and without cross joins."""
    found = QUERIES[name](spark, FOLDER)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert differences(found, con, ORACLES[name]) is None


def test_entry_points(spark):
    assert entry_point.entry(spark).count() > 0
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
    assert set(QUERIES) <= set(entry_point.queries())


def test_long_texts_are_not_shuffled(spark):
    """Distinct counts and top values of documents exchange keys and digests only."""
    plan = profile(spark.read.parquet(f"{FOLDER}/documents.parquet")).columns
    text = plan._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and not any("text#" in line for line in exchanges)
    assert "sha2" in text
