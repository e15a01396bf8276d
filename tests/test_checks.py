"""Every registered query against its SQL, on the whole tables of the smallest scale."""

from __future__ import annotations

import pytest

from checks import load
from checks.compare import connect, differ

QUERIES, ORACLES = load()
# No all-pairs join, and no Python in the path of the rows.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas")


@pytest.fixture(scope="module")
def duck(small):
    con = connect(small)
    yield con
    con.close()


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, small, duck, name):
    query = QUERIES[name](spark, small)
    plan = query._jdf.queryExecution().executedPlan().toString()
    for word in UNWANTED:
        assert word not in plan
    assert differ(query.toPandas(), duck.sql(ORACLES[name]).df()) is None
