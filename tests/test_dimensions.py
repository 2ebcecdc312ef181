import pytest
from pyspark.sql import functions as F
from telarium import __main__ as cli
from telarium.operators import dimensions as D
from telarium.operators import search


def test_lookup(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "z", "x"), (3, None, "x")], "i int, k string, name string")
    dim = spark.createDataFrame([("a", "Alfa", 1)], "k string, name string, i int")
    got = D.lookup(df, dim, {"k": "k"}, {"name": "label"}, {"label": F.lit("?")}).orderBy("i").collect()
    assert [tuple(r) for r in got] == [(1, "a", "x", "Alfa"), (2, "z", "x", "?"), (3, None, "x", "?")]
    got = D.by_rule(df, [("k = 'a'", "first"), ("k IS NULL", "none")], "other", "c").orderBy("i").collect()
    assert [r.c for r in got] == ["first", "other", "none"]


def test_tokens(spark):
    df = spark.createDataFrame([(["secundaria", " 1m "],)], "t array<string>")
    known, groups = ["7B", "8B", "1M", "2M"], {"SECUNDARIA": ["7B", "8B", "1M", "2M"]}
    assert D.expand_tokens(df, "t", groups, known).first().levels == ["7B", "8B", "1M", "2M"]
    with pytest.raises(Exception, match="unknown token: 9M"):
        D.expand_tokens(spark.createDataFrame([(["9M"],)], "t array<string>"), "t", groups, known).collect()


def test_tree(spark):
    parents = spark.createDataFrame([(1, "b", "Dimensión física", "2020"), (2, "b", "dimension FISICA", "2021"), (3, "b", "Moral", None)], "pid int, base string, title string, created string")
    children = spark.createDataFrame([(10, 1, "OAT 3", "x", 1), (11, 2, "1", "y", 2), (12, 2, None, "z", 3), (13, 3, "7", "w", 4), (14, 9, "1", "v", 5)], "cid int, parent int, number string, statement string, ord int")
    got = sorted((r.id, r.statement) for r in D.tree_ids(parents, children, "CL").collect())
    assert got == [("CL_B_DIMENSION_FISICA_01", "y"), ("CL_B_DIMENSION_FISICA_02", "z"), ("CL_B_MORAL_07", "w")]


def test_highlight(spark):
    df = spark.createDataFrame([("La CÉLULA & las células <b>",), (None,)], "t string")
    got = [r.x for r in df.select(search.highlight(F.col("t"), "celula la a").alias("x")).collect()]
    assert got == ["<mark>La</mark> <mark>CÉLULA</mark> &amp; <mark>la</mark>s <mark>célula</mark>s &lt;b&gt;", ""]


def test_command_line(spark, tmp_path, capsys):
    assert cli.main(["list"]) == 0 and "totals" in capsys.readouterr().out
    assert cli.main(["run", "nada", "--data", "x", "--out", "y"]) == 2
    spark.createDataFrame([("a/b", "B", "A", "tp", False)], "offering_key string, subject_name string, level_name string, track string, is_epja boolean").write.parquet(str(tmp_path / "offerings.parquet"))
    spark.createDataFrame([(1, "a/b")], "row_id long, offering_key string").write.parquet(str(tmp_path / "objectives.parquet"))
    assert cli.main(["run", "offering_lookup", "--data", str(tmp_path), "--out", str(tmp_path / "o"), "--format", "json"]) == 0
    assert spark.read.json(str(tmp_path / "o/offering_lookup")).first().area == "tp"
