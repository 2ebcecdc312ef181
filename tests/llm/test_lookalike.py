import pytest
from telarium.llm import lookalike as L


@pytest.mark.parametrize("text, form", [
    ("раra", "para"), ("ｅｎ ｅｌ ｖａｌｌｅ", "en el valle"), ("cronómetro", "cronómetro"), ("a​b\xadc", "abc"), ("la red b", "la red b"), ("ﬁja", "fija"), ("físico‑químico", "físico-químico"),
    ("m², ½, 3.º, 2.ª, 25 °C… – «x» “y” •", "m², ½, 3.º, 2.ª, 25 °C… – «x» “y” •"), ("ángulo α y π", "ángulo α y π"), ("el у la", "el y la"), ("diνersa", "diversa"), ("кит и лес", "кит и лес"), ("a\tb\n c  d�", "a\tb\n c  d�"), ("", ""), ("日月", "日月"),
])
def test_table(text, form):
    assert L.consistent(text) == form


def test_null():
    assert L.consistent(None) is None


def test_trie_costs():
    t = L.Trie([("valle", 9), ("valla", 20), ("fija", 3), ("cronómetro", 2)])
    assert t.match("vаllе") == ("valle", 0.0)
    assert t.match("ﬁ​ja") == ("fija", 0.0)
    assert t.match("cronómetro") == ("cronómetro", 0.0)
    assert t.match("vallo") is None
    assert t.match("vallo", budget=1.0) == ("valla", 1.0)  # the more frequent of equal cost
    assert t.match("") is None and L.Trie([]).match("x") is None


def frame(spark, rows):
    return spark.createDataFrame(rows, "row_id long, statement string, text string, pos int")


def test_changed_and_normalized(spark):
    a = frame(spark, [(1, "Medir lа rеd", "x", 1), (2, "Medir la red", None, None), (3, None, None, None), (4, "", None, None), (5, "ｍｅｄｉｒ la red", None, None), (6, "Medir la red", None, None)])
    b = frame(spark, [(1, "El ángulo α", None, None), (7, "Ver " + "sí " * 30_000 + "fi​n", None, None)])
    tables = [("a", a), ("b", b)]
    got = {(r.table_name, r.row_id): r.text for r in L.changed(tables).collect()}
    assert set(got) == {("a", 1), ("a", 5), ("b", 7)} and got["a", 1] == "Medir la red" and got["b", 7].endswith("fin")
    every = {(r.table_name, r.row_id): r.statement for r in L.normalized(tables).collect()}
    assert len(every) == 8 and every["a", 3] is None and every["a", 4] == "" and every["a", 5] == "medir la red" and every["b", 1] == "El ángulo α"


def test_empty(spark):
    e = frame(spark, [])
    assert L.changed([("a", e)]).count() == 0 and L.normalized([("a", e)]).count() == 0


def test_case_comes_back():
    assert L._cased("valle", "VALLE") == "VALLE" and L._cased("valla", "Valle") == "Valla" and L._cased("valla", "VALLE") == "VALLA"


def test_ignorables_beyond_the_first_planes():
    assert L.consistent("".join("va" + chr(c) + "lle " for c in (0xE0001, 0xE0061, 0xE007F, 0xE0100, 0xE01EF))) == "valle " * 5


def test_ambiguous_lookalikes_follow_the_words(spark):
    """The table has one letter for a look-alike, the trie the words it may spell."""
    df = spark.createDataFrame([(i, "vino y uva") for i in range(3)] + [(9, "υino y υva")], "row_id long, statement string")
    assert L.table_form("υino") == "uino"
    assert [r.text for r in L.changed([("t", df)]).collect()] == ["vino y uva"]


def test_bins_are_divided(spark):
    words = spark.createDataFrame([(f"cont{a}{b}", 5) for a in "abcdefgh" for b in "abcdefgh"], "word string, n long")
    pieces = [(f"сont{a}{b}", L.table_form(f"сont{a}{b}")) for a in "abcdefgh" for b in "abcdefgh"]
    tokens = spark.createDataFrame([(p, q, L.prefixes(p, q)) for p, q in pieces], "piece string, plain string, bins array<string>")
    whole, parts = ({tuple(r) for r in L.spellings(words, tokens, most=m).collect()} for m in (1000, 5))
    assert whole == parts == {(p, q) for p, q in pieces}


def test_rows_of_one_id_stay_apart(spark):
    rows = [(1, "mesa\u200b grande"), (1, "papel\u200b blanco"), (1, "papel\u200b blanco"), (2, "mesa")]
    df = spark.createDataFrame(rows, "row_id long, statement string")
    assert sorted(r.text for r in L.changed([("t", df)]).collect()) == ["mesa grande", "papel blanco"]
    assert sorted(r.statement for r in L.normalized([("t", df)]).collect()) == ["mesa", "mesa grande", "papel blanco", "papel blanco"]
