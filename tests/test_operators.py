import random

from pyspark.sql import functions as F
from telarium.operators import aggregates, audits, matching, merging, ordering, search


def test_bands_against_brute_force(spark):
    r = random.Random(1)
    items = [(r.randrange(3), r.uniform(0, 100), i) for i in range(200)]
    marks = [(r.randrange(3), r.uniform(0, 100), 1000 + i) for i in range(20)]
    got = {x.i: x.m for x in ordering.assign_bands(spark.createDataFrame(items, "g int, y double, i int"), spark.createDataFrame(marks, "g int, y double, m int"), ["g"], "y", "m", 5.0).collect()}
    for g, y, i in items:
        before = [(my, m) for mg, my, m in marks if mg == g and my <= y + 5]
        assert got[i] == (max(before)[1] if before else None)


def test_ids_labels_groups_medians(spark):
    df = spark.createDataFrame([(1, "a", "h", 1.0), (2, "a", None, 2.0), (3, "b", None, 3.0), (4, "a", "k", 4.0), (5, None, None, None)], "i int, id string, label string, v double")
    assert [r.unique_id for r in ordering.unique_ids(df, "id", ["i"]).orderBy("i").collect()] == ["a", "a__2", "b", "a__3", None]
    one = df.withColumn("g", F.lit(1))
    assert [r.l for r in ordering.carry_forward(one, ["g"], ["i"], F.col("label"), "l").orderBy("i").collect()] == ["h", "h", "h", "k", "k"]
    got = ordering.regroup(one.where("id IS NOT NULL"), ["g"], ["i"], F.col("label").isNotNull(), "id").orderBy("nr").collect()
    assert [(r.nr, r.n, r.text) for r in got] == [(1, 3, "a a b"), (2, 1, "a")]
    assert ordering.upper_median(one, ["g"], "v").first().median == 3.0


STATEMENTS = ["Analizar los procesos de la fotosíntesis en plantas y algas", "Analizar los procesos de la respiración en plantas y animales", "Escribir cuentos breves sobre el mar y sus estaciones", "Resolver ecuaciones lineales con dos incógnitas en contexto"]


def frames(spark):
    obj = spark.createDataFrame([(10 + i, "g", s, f"OA {i + 1}") for i, s in enumerate(STATEMENTS)] + [(20, "g", None, None), (30, "h", STATEMENTS[0], "OA 1")], "oid int, g string, statement string, code string")
    rows = spark.createDataFrame([(1, "g", STATEMENTS[0] + " verdes", "OA 1"), (2, "g", "OA 2. " + STATEMENTS[2], "OA 9"), (3, "g", "Otra cosa muy distinta que no se parece a nada de esto", "OA 3"), (4, "g", None, "x"), (5, "z", STATEMENTS[0], "OA 1")], "rid int, g string, statement string, code string")
    return rows, obj


def test_scores_and_prefilter_agree(spark):
    rows, obj = frames(spark)
    every = {(r.row, r.objective): r.score for r in matching.scores(rows, obj, "rid", "oid", "g").collect()}
    some = {(r.row, r.objective): r.score for r in matching.scores(rows, obj, "rid", "oid", "g", least=0.3).collect()}
    assert some == {k: v for k, v in every.items() if v >= 0.3} and every[1, 10] > 0.9 and (5, 10) not in every


def test_decisions(spark):
    s = spark.createDataFrame([(1, 10, 0.9), (1, 11, 0.5), (2, 10, 0.8), (2, 11, 0.75), (3, 10, 0.8), (3, 11, 0.75), (4, 10, 0.4), (5, 12, 0.6), (6, 10, 0.7), (6, 11, 0.7)], "row int, objective int, score double")
    agrees = spark.createDataFrame([(2, 11), (6, 10), (6, 11)], "row int, objective int")
    got = {r.row: (r.outcome, r.objective) for r in matching.decide(s, agrees).collect()}
    assert got == {1: ("attached", 10), 2: ("attached", 11), 3: ("ambiguous", None), 4: ("rejected", 10), 5: ("attached", 12), 6: ("ambiguous", None)}
    assert {(r.row, r.objective) for r in matching.first_match(s).collect()} == {(1, 10), (2, 10), (3, 10), (5, 12), (6, 10)}


def test_attached_items(spark):
    d = spark.createDataFrame([(1, "attached", 10, 0.9), (2, "attached", 10, 0.9), (3, "rejected", None, 0.1)], "row int, outcome string, objective int, score double")
    rows = spark.createDataFrame([(1, ["b", "a"]), (2, ["a", "c"]), (3, ["x"])], "rid int, items array<string>")
    assert [(r.objective, r.n_rows, r["items"]) for r in matching.attach_lists(d, rows, "rid", "items").collect()] == [(10, 2, ["a", "b", "c"])]


def test_routes(spark):
    rows = [(1, "a", True, "x"), (2, "a", False, "y"), (3, "b", False, "x"), (4, "b", True, "y"), (5, "c", True, "x"), (6, "c", True, "y"), (7, "d", False, "x"), (8, "d", False, "y")]
    got = {r.i: (r.outcome, r.stored_as) for r in merging.insert_with_preference(spark.createDataFrame(rows, "i int, k string, has boolean, base string"), ["k"], F.col("has"), ["i"], "base").collect()}
    assert got == {1: ("new", "a"), 2: ("folded", "a"), 3: ("folded", "b"), 4: ("kept", "b"), 5: ("new", "c"), 6: ("qualified", "c__y"), 7: ("new", "d"), 8: ("qualified", "d__y")}


def test_coverage_differences_corrections(spark):
    exp, held = spark.createDataFrame([("a",), ("b",), ("c",)], "k string"), spark.createDataFrame([("a", 2), ("b", 0), ("d", 1)], "k string, n int")
    assert {r.k: r.status for r in merging.coverage(exp, held, ["k"]).collect()} == {"a": "ingested", "b": "empty", "c": "missing", "d": "unexpected"}
    s, l = spark.createDataFrame([("a", "x", None), ("b", "x", "y"), ("c", "x", "y"), (None, "q", "q")], "k string, f string, g string"), spark.createDataFrame([("a", "x", ""), ("b", "z", "w"), ("d", "x", "y")], "k string, f string, g string")
    assert {tuple(r) for r in merging.differences(s, l, "k", ["f", "g"]).collect()} == {("b", "f", "differs"), ("b", "g", "differs"), ("c", "*", "extra"), ("d", "*", "missing")}
    df, c = spark.createDataFrame([(1, "old"), (2, "new"), (3, "other"), (4, None)], "i int, v string"), spark.createDataFrame([(i, "old", "new") for i in (1, 2, 3)], "i int, original_value string, corrected_value string")
    assert {r.i: (r.v, r.correction_status) for r in merging.compare_and_set(df, c, ["i"], "v").collect()} == {1: ("new", "applied"), 2: ("new", "already applied"), 3: ("other", "skipped"), 4: (None, None)}


def test_audits(spark):
    df = spark.createDataFrame([
        (1, "CL_1", "A", "1_medio", "m", "Medir el agua", "s", "u", "vigente"), (2, "CL_2", "B", "1_medio", "m", "medir el AGUA.", None, "u", "vigente"), (3, "CL_3", "A", "1_medio", "m", "Otra cosa", "s", None, None),
        (4, "CL_4", "C", "3_medio", "m", "Leer más", "s", "w", "raro"), (5, "CL_4", "C", "4_medio", "m", "Leer más", "s", "w", "desconocido"), (6, "CL_6", None, None, None, None, None, None, None),
    ], "row_id long, oa_id string, code string, level_id string, subject_id string, statement string, source string, source_url string, curriculum_status string").withColumn("offering_key", F.concat_ws("/", "level_id", "subject_id")).withColumn("retrieved_at", F.lit(None).cast("timestamp"))
    assert [tuple(r)[2:] for r in audits.same_text_different_codes(df).collect()] == [(2, 2)]
    assert {r.code: r["class"] for r in audits.code_classes(df).collect()} == {"A": "different_text", "C": "shared_expected"}
    assert [tuple(r) for r in audits.duplicate_ids(df).collect()] == [("CL_4", 2, False)]
    assert {tuple(r) for r in audits.routes_used_twice(df).collect()} == {("w", 2)}
    assert {r.problem: r.n for r in audits.provenance(df).collect()} == {"no_source": 2, "no_source_url": 1, "no_retrieved_at": 3}
    assert {(r.row_id, r.problem) for r in audits.status_without_source(df, ["vigente", "desconocido"]).collect()} == {(2, "unsourced"), (3, "missing"), (4, "unknown"), (6, "missing")}
    assert {tuple(r) for r in audits.violations(df, {"code": "code IS NOT NULL", "len": "length(statement) > 8"}).collect()} == {(4, "len"), (5, "len"), (6, "code"), (6, "len")}
    assert {tuple(r) for r in audits.regression(df, df.where("row_id < 6").withColumn("oa_id", F.when(F.col("row_id") == 1, "CL_0").otherwise(F.col("oa_id"))), "oa_id").collect()} == {("CL_1", "added"), ("CL_6", "added"), ("CL_0", "removed")}
    assert aggregates.totals(df.withColumn("category", F.lit("actitud"))).first().actitud == 6


def test_search(spark):
    df = spark.createDataFrame([(1, "Medir la célula", "MA OA 1", True), (2, "Analizar células y medidas", "X", False), (3, "Nada", None, None), (4, None, None, None)], "row_id long, statement string, code string, prioritized boolean")
    post = search.postings(df, "row_id", [F.col("statement"), F.col("code")])
    hits = lambda q: sorted(r.row_id for r in search.matching(post, "row_id", q).collect())
    assert hits("celula medi") == [1, 2] and hits("célula medir") == [1] and hits("o") == [] and hits("oa") == [1] and hits("  ") == []
    s = search.score("medir célula", F.col("code"), F.col("statement"), F.lit(None), F.lit(None), F.lit(None), F.col("prioritized"))
    assert [r.s for r in df.select(s.alias("s"), "row_id").orderBy("row_id").collect()] == [33, 10, 0, 0]
    assert [r.row_id for r in search.substring(df, "CÉLULA", [F.col("statement")]).orderBy("row_id").collect()] == [1, 2] and search.substring(df, "", [F.col("statement")]).count() == 4
    b = {r.row_id: r.score for r in search.bm25(df, "row_id", F.col("statement"), "célula medir").collect()}
    assert set(b) == {1}
    assert [r.x for r in df.select(search.explain("celula", s=F.col("statement"), c=F.col("code")).alias("x")).collect()] == [["s"], ["s"], [], []]
    assert df.select(search.excerpt(F.col("statement"), "células", 3, 5).alias("x")).collect()[1].x == "…ar células y me…"
    codes = spark.createDataFrame([("OA 10",), ("OA 9",), ("OA 1 b",)], "c string")
    assert [r.c for r in codes.orderBy(search.code_order(F.col("c"))).collect()] == ["OA 1 b", "OA 9", "OA 10"]


def test_progression(spark):
    df = spark.createDataFrame([(1, "A", "s", "m", 1, "l1"), (2, "A", None, "x", 9, "l1"), (3, "B", "s", "m", 1, "l2"), (4, "C", "s", "m", 2, "l2"), (5, None, None, None, None, None)], "row_id long, code string, strand_eje string, subject_id string, oa_number int, level_id string")
    assert {tuple(r) for r in search.progression(df).collect()} == {(1, 2), (2, 1), (1, 3), (3, 1)}
