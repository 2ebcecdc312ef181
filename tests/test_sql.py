import os

import pytest
from sql import DATA, agree, connect
from telarium import queries as Q

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect()


@pytest.mark.parametrize("name", list(Q.ORACLE))
def test_sql(spark, con, name):
    agree(spark, con, Q.QUERIES[name], Q.ORACLE[name])


@pytest.mark.parametrize("name", [n for n in Q.QUERIES if n not in Q.ORACLE])
def test_runs(spark, name):
    assert Q.QUERIES[name](spark, DATA).count() >= 0


def test_entities_of_nested_records_agree(spark):
    """The flat tables hold as many rows as found_nodes has of each kind, and every parent path exists."""
    found = Q.QUERIES["p3_found"](spark, DATA).toPandas()
    for node in ("level", "subject", "objective", "module", "learning"):
        flat = Q.QUERIES[f"p3_{node}s"](spark, DATA).toPandas()
        assert len(flat) == (found.node == node).sum()
    have = set(zip(found.record_id, found.path))
    assert all((i, p) in have for i, p in zip(found.record_id, found.parent_path) if p)
