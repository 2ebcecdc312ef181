import os

import pytest
from sql import DATA, agree, connect
from telarium.llm import queries as Q

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")

COLUMNS = {
    "p1_found": ["row_id", "table_name"], "p2_found": ["noise", "pos", "row_id", "table_name"], "p4_found": ["row_a", "row_b"], "p5_found": ["row_id", "table_name"],
    "p6_found": ["copy_id", "keep_id", "table_name"], "p7_ids": ["doc_id", "ids"], "p9_found": ["doc_id"],
}


@pytest.fixture(scope="module")
def con():
    return connect()


@pytest.mark.parametrize("name", list(Q.ORACLE))
def test_sql(spark, con, name):
    agree(spark, con, Q.QUERIES[name], Q.ORACLE[name])


@pytest.mark.parametrize("name", [n for n in Q.QUERIES if n not in Q.ORACLE])
def test_runs(spark, name):
    df = Q.QUERIES[name](spark, DATA)
    rows = df.collect()
    assert sorted(df.columns) == COLUMNS.get(name, sorted(df.columns))
    if name in COLUMNS and name != "p2_found":
        keys = [tuple(str(v) for v in r) for r in rows]
        assert len(keys) == len(set(keys))


def test_consistent_texts_are_found_no_more(spark):
    """Rows whose text the operator has normalized hold nothing unordinary any longer."""
    from telarium.llm import lookalike

    text = Q.QUERIES["p5_text"](spark, DATA)
    again = [(n, text.where(f"table_name = '{n}'").select("row_id", "statement")) for n in ("objectives", "bases_objectives")]
    assert lookalike.changed(again).count() == 0
