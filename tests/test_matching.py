"""Queries that match rows by their statements, on one large group: equal to SQL, and little is written for them."""

import random

import pytest
from telarium import queries as Q
from telarium.operators import matching

WORDS = "analizar procesos fotosintesis plantas escribir cuentos breves sobre resolver ecuaciones lineales contexto describir paisajes explicar respiracion animales comparar fuentes historicas medir longitudes".split()
#: 18 of the 40 grams of each are shared: a score of 0.45 exactly.
EDGE = ("abcdefghijklmnopqrstuv0123456789wxyzazbycxdw", "abcdefghijklmnopqrstuvwvutsrqponmlkjihgfedcb")


def statement(r: random.Random) -> str:
    return " ".join(r.choice(WORDS) for _ in range(r.randrange(3, 16)))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d, r = str(tmp_path_factory.mktemp("matching")), random.Random(7)
    said = [statement(r) for _ in range(400)]
    code = lambda: r.choice(["OA 1"] * 12 + ["oa-1", "OA 2", "", None])
    edited = lambda: r.choice(said) + r.choice(["", " " + r.choice(WORDS)])
    kind = lambda: r.choice(["habilidad", "actitud", None])
    obj = [(i, code(), r.choice(said) if r.random() < 0.9 else r.choice([None, "", "corto"]), kind()) for i in range(600)] + [(1000, "OA 9", EDGE[0], "actitud")]
    raw = [(5000 + i, code(), edited() if r.random() < 0.9 else statement(r), kind()) for i in range(300)] + [(9000, "OA 9", EDGE[1], "actitud")]
    for name, rows in (("objectives", obj), ("raw_objectives", raw)):
        spark.createDataFrame(rows, "row_id long, code string, statement string, category string").write.parquet(f"{d}/{name}.parquet")
    return d


def shuffled(spark) -> int:
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    own = spark.sparkContext._jsc.sc().statusStore().executorList(True)
    return sum(own.apply(i).totalShuffleWrite() for i in range(own.size()))


@pytest.mark.parametrize("name", ["attach_best", "attach_outcomes", "link_first", "statement_scores"])
@pytest.mark.parametrize("block", [8192, 64])
def test_large_group(spark, folder, name, block, monkeypatch):
    import duckdb

    monkeypatch.setattr(matching, "BLOCK", block, raising=False)
    before = shuffled(spark)
    got = sorted(map(repr, map(tuple, Q.QUERIES[name](spark, folder).collect())))
    written = shuffled(spark) - before
    con = duckdb.connect()
    for t in ("objectives", "raw_objectives"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    assert got == sorted(map(repr, con.sql(Q.ORACLE[name]).fetchall()))
    if block == 8192:
        assert written < 400_000  # there are 80,000 characters of text


def test_pairs_in_parts(monkeypatch):
    """Small parts give the same pairs, equal texts one pair for each of their places, and near pairs are those that decide."""
    r = random.Random(3)
    compact = lambda: statement(r).replace(" ", "") + "x" * 25
    b = [compact() for _ in range(40)]
    b += b[:10]
    a = [compact() for _ in range(20)] + b[:8] * 2
    grams = lambda t: {t[i:i + 5] for i in range(len(t) - 4)}
    want = {(i, j): len(grams(x) & grams(y)) / min(len(grams(x)), len(grams(y))) for i, x in enumerate(a) for j, y in enumerate(b)}
    for cells, postings, pairs in ((1 << 17, 1 << 20, 1 << 18), (1, 1, 1), (120, 50, 7)):
        for k, v in (("CELLS", cells), ("POSTINGS", postings), ("PAIRS", pairs)):
            monkeypatch.setattr(matching, k, v)
        for least in (0.0, 0.45):
            found = [x for part in matching._compare(a, b, least, None) for x in zip(*(y.tolist() for y in part))]
            assert len(found) == len({x[:2] for x in found}) and {x[:2]: x[2] for x in found} == {k: v for k, v in want.items() if v > 0 and v >= least}
        near = {x[:2] for part in matching._compare(a, b, 0.0, 0.1) for x in zip(*(y.tolist() for y in part))}
        for i in range(len(a)):
            s = sorted((v for (x, _), v in want.items() if x == i), reverse=True)
            assert {j for x, j in near if x == i} == {j for j in range(len(b)) if s[0] - want[i, j] < 0.1 or want[i, j] >= s[1]}


@pytest.fixture(scope="module")
def copies(spark, tmp_path_factory):
    """40 statements of one group, each 10 times in objectives and 5 times in rows, with other keys and kinds."""
    d, r = str(tmp_path_factory.mktemp("copies")), random.Random(11)
    said = [f"{statement(r)} {WORDS[i % len(WORDS)]} caso {i}" for i in range(40)]
    kind = lambda: r.choice(["habilidad", "actitud", None])
    for name, n in (("objectives", 400), ("raw_objectives", 200)):
        rows = [(i, "OA 1", said[i % 40], kind()) for i in range(n)]
        spark.createDataFrame(rows, "row_id long, code string, statement string, category string").coalesce(2).write.parquet(f"{d}/{name}.parquet")
    return d


def check_copies(spark, folder, name) -> int:
    """Compares with SQL; what was shuffled."""
    import duckdb

    before = shuffled(spark)
    got = sorted(map(repr, map(tuple, Q.QUERIES[name](spark, folder).collect())))
    written = shuffled(spark) - before
    con = duckdb.connect()
    for t in ("objectives", "raw_objectives"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    assert got == sorted(map(repr, con.sql(Q.ORACLE[name]).fetchall()))
    return written


def test_scores_of_copies(spark, copies, monkeypatch):
    """Copies of few statements make no further blocks, so no text is shuffled more than once."""
    once = check_copies(spark, copies, "statement_scores")
    monkeypatch.setattr(matching, "BLOCK", 48)
    assert check_copies(spark, copies, "statement_scores") < 1.2 * once


@pytest.mark.parametrize("block", [8192, 16])
def test_outcomes_of_copies(spark, copies, block, monkeypatch):
    """What is shuffled follows the rows, not the pairs, of which there are ten times as many as rows."""
    monkeypatch.setattr(matching, "BLOCK", block)
    for name in ("attach_best", "attach_outcomes"):
        written = check_copies(spark, copies, name)
        assert block == 16 or written < 60_000
