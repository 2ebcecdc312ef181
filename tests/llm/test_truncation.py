import random

from telarium.llm import truncation as X

NOUNS = ["el agua", "la célula", "el cuento", "la fuente", "el mapa", "la tabla", "el volcán", "la medida"]
ADJ = ["fuerte", "lenta", "social", "visual", "local", "rural", "natural", "personal"]


def sentence(r):
    np = lambda: f"{r.choice(NOUNS)} {r.choice(ADJ)}"
    return f"Analizar {np()} para describir {np()}, según {np()} y {np()} de {np()}."


def table(spark, rows):
    return spark.createDataFrame(rows, "row_id long, source string, statement string, state string, w string")


def data():
    r = random.Random(3)
    rows = [(i, "a", sentence(r), None, None) for i in range(600)]
    cut = {}
    for i in range(600, 640):
        s = sentence(r)
        words = s.split()
        k = max(j for j, w in enumerate(words[:-3]) if w in ("el", "la", "según", "para", "y", "de"))
        cut[i] = " ".join(words[:k + 1])
    for i in range(640, 660):
        s = sentence(r)
        cut[i] = s[:s.rfind("describir") + r.randint(3, 6)]
    for i in range(660, 680):
        cut[i] = " ".join(sentence(r).split()[:8]) + r.choice(["…", " […]", " (...)", "... (ver más)"])
    rows += [(i, "b", s, None, None) for i, s in cut.items()]
    rows += [(700 + i, "c", sentence(r)[:-1], None, None) for i in range(40)]  # complete without the point
    rows += [(800, "a", None, "x", "y"), (801, "a", "", None, None), (802, None, "  \n", None, None), (803, None, sentence(r), None, None), (804, "a", sentence(r) + " ;", None, None), (805, "a", sentence(r)[:-1] + "!", None, None), (806, "a", "…", None, None)]
    return rows, set(cut)


def test_planted_cuts(spark):
    rows, cut = data()
    got = {r.row_id for r in X.cuts([("t", table(spark, rows))]).collect()}
    assert got == cut


def test_limits_of_a_source(spark):
    r = random.Random(5)
    rows = [(i, "s", sentence(r), None, None) for i in range(300)] + [(1000 + i, "s", (sentence(r)[:-1] + " " + sentence(r))[:100], None, None) for i in range(60)]
    got = {x.row_id for x in X.cuts([("t", table(spark, rows))]).collect()}
    assert {i for i, _, s, _, _ in rows if i >= 1000 and s[-1] != "."} <= got and not {i for i in got if i < 1000}


def test_shares_and_empty_tables(spark):
    rows, cut = data()
    got = {r.source: r for r in X.by_source([("t", table(spark, rows)), ("u", table(spark, []))]).collect()}
    assert got["b"].n_cut == len(cut) and got["b"].share == 1.0 and got["c"].n_cut == 0 and got[None].n_rows == 1
    assert X.cuts([("t", table(spark, []))]).count() == 0


def test_long_text_and_repeated_rows(spark):
    rows, cut = data()
    long = "Analizar el agua fuerte para describir la célula lenta " * 3000
    rows += [(900, "b", long + "y la", None, None)] * 2 + [(901, "b", long + "social.", None, None)]
    got = [r.row_id for r in X.cuts([("t", table(spark, rows))]).collect()]
    assert got.count(900) == 2 and got.count(901) == 0


def test_three_points(spark):
    """Open ends before three points are judged as without them; they make a habit, also of the null source."""
    r = random.Random(5)
    rows = [(i, "a", sentence(r), None, None) for i in range(800)]
    rows += [(900, "a", "Analizar el agua fuerte para describir la tabla social de...", None, None), (901, "a", sentence(r)[:-1] + "...", None, None), (902, "a", sentence(r) + "...", None, None)]
    rows += [(1000 + 100 * k + i, s, sentence(r)[:-1] + "..." if i < 12 else sentence(r), None, None) for k, s in enumerate(["b", None]) for i in range(40)]
    rows += [(1300, "b", sentence(r) + "...", None, None)]  # cut behind a sentence
    got = {x.row_id: x.reason for x in X.cuts([("t", table(spark, rows))]).collect()}
    assert 900 in got and 901 not in got and 902 not in got
    assert {i: k for i, k in got.items() if i >= 1000} == {1000 + 100 * k + i: "dots" for k in range(2) for i in range(12)} | {1300: "dots"}


def test_trailing_blanks_of_any_length(spark):
    rows, cut = data()
    rows += [(910, "a", sentence(random.Random(1)) + " " * 60, None, None), (911, "b", "Analizar el agua fuerte (ver más)" + " " * 80, None, None), (912, "a", sentence(random.Random(2)) + " ;" * 50, None, None)]
    got = {r.row_id: r.reason for r in X.cuts([("t", table(spark, rows))]).collect()}
    assert got[911] == "stop" and 910 not in got and 912 not in got


def test_ends_are_judged_by_their_trigrams(spark):
    """A pair that often ends texts stands behind one word inside only: no shorter end and no other rule could tell."""
    rows = [(i, "a", f"El grupo {w} usa mapa rural siempre y luego dibuja mapa rural.", None, None) for i, w in enumerate(["uno", "dos", "tres", "seis"] * 15)]
    rows += [(100, "a", "El grupo mayor usa mapa rural", None, None), (101, "a", "El grupo mayor dibuja mapa rural", None, None)]
    assert {r.row_id: r.reason for r in X.cuts([("t", table(spark, rows))]).collect()} == {100: "trigram"}
