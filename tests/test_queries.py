"""Every registered query against its SQL, and what its plan may not contain."""

import pytest
from oracle import connect, differences

from releasecat.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_dir, connection, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name in ORACLES:
        assert differences(df, connection, ORACLES[name]) == []
    else:
        assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
