"""Every registered query against the same in SQL, on the smallest tables."""

import os

import pytest
from oracle import compare, connect

import __spark_entry__
from sluice.queries import ALL

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the test tables")


@pytest.fixture(scope="module")
def tables():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(ALL))
def test_query(spark, tables, name):
    frame = ALL[name].run(spark, SF_DIR)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert compare(frame, tables, ALL[name].sql) is None


def test_entry(spark):
    assert ALL.keys() <= __spark_entry__.oracle_sql().keys() <= __spark_entry__.queries().keys()
    assert __spark_entry__.entry(spark).count() > 0
