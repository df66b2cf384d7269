"""Every registered query against its SQL in DuckDB, and rules that all plans must keep."""

import pytest

from harness.registry import ORACLES, QUERIES
from tests.oracle import compare, connection

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connection(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_oracle(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    assert compare(frame, duck, ORACLES[name]) is None
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert node not in plan


def test_entry_gives_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
