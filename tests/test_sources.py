from telarium.plans import exports
from telarium.sources import layout, pages, prose
from telarium.streaming import ingest
from pyspark.sql import functions as F

HTML = """<html><body><ol class="breadcrumb"><li>Inicio</li><li>Currículum</li><li>Base X</li><li>Mate &amp; más</li></ol><h1>Matemática 1</h1>
<a class="link-button-more" href="/r?field_cn_subjects=5&field_cn_grades=9">Arma</a><a class="link-button-more" href="/b?f[0]=bases%3A77">x</a>
<div class="documents-wrapper"><article><span class="badge">Programa</span><h3><a href="/docs/p.pdf">El <b>programa</b></a></h3></article><article><h3>sin enlace</h3></article></div>
<div class="items-wrapper"><h3 id="eje-109--176">Números</h3>
<div class="item-wrapper prioritized"><span class="oa-title">Objetivo de Aprendizaje</span><span class="number-title">MA1M OA 01</span><div class="field--name-description"><p>Calcular:</p><ul><li>uno</li><li>uno</li><li>dos<br>tres</li></ul></div><a class="link-more" href="/c/1">más</a></div>
<div class="item-wrapper"><span class="oa-title">Objetivo de Aprendizaje de actitud A</span><div class="field--name-description">Texto  suelto<script>x()</script></div></div>
<div class="item-wrapper"></div></div><a href="/curriculum/b/s/g?x=1">l</a><a href="https://h/curriculum/b/curso/g">n</a></body>"""


def test_pages(spark):
    df = spark.createDataFrame([("https://h/curriculum/base/mate/1-medio", HTML, 1), ("https://h/otra", HTML, 2), ("https://h/curriculum/a/b/c", None, 3), ("https://h/curriculum/a/b/d", "", 4)], "url string, html string, objectives int")
    rec = {r.url: r for r in pages.read_pages(df).collect()}
    assert set(rec) == {"https://h/curriculum/base/mate/1-medio", "https://h/curriculum/a/b/d"}
    r = rec["https://h/curriculum/base/mate/1-medio"]
    assert (r.base_slug, r.subject_slug, r.grade_slug, r.page_title, r.base_name, r.subject_name, r.source_subject_id, r.source_grade_id, r.source_base_id) == ("base", "mate", "1-medio", "Matemática 1", "Base X", "Mate & más", "5", "9", "77")
    assert [tuple(d) for d in r.documents] == [("Programa", "El programa", "https://h/docs/p.pdf")]
    a, b = r.objectives
    assert (a.code, a.statement, a.category, a.strand_name, a.strand_kind, a.strand_term_id, a.prioritized, a.detail_url) == ("MA1M OA 01", "Calcular:\n- uno\n- dostres", "conocimiento", "Números", "Eje", "176", True, "https://h/c/1")
    assert (b.code, b.statement, b.category, b.prioritized) == ("A", "Texto suelto", "actitud", False)
    assert [(o.ord, o.position) for o in pages.objectives(pages.read_pages(df)).orderBy("ord").collect()] == [(0, 1), (1, 1)]
    assert {r.path for r in pages.links(df).collect()} == {"/curriculum/b/s/g"}
    assert pages.read_pages(df.limit(0)).count() == 0


def test_sectors(spark):
    df = spark.createDataFrame([("d", 1, "link", "z"), ("d", 2, "heading", "Salud"), ("d", 3, "link", "a"), ("d", 4, "heading", "Otro"), ("d", 5, "link", "b"), ("d", 6, "heading", "Minería"), ("d", 7, "link", "a"), ("d", 8, "link", "c")], "doc string, pos int, kind string, value string")
    assert {(r.slug, r.sector) for r in pages.sectors(df, ["Salud", "Minería"]).collect()} == {("a", "Salud"), ("c", "Minería")}


def blocks(spark, rows):
    return spark.createDataFrame([("d", p, i, float(x), float(y), t) for i, (p, x, y, t) in enumerate(rows)], "doc string, page int, ord int, x0 double, y0 double, text string")


HEAD = [(1, 50, 40, "Objetivos de Aprendizaje"), (1, 300, 40, "Indicadores de Evaluación"), (1, 300, 55, "Los estudiantes que han alcanzado este aprendizaje:")]


def test_rows_by_band(spark):
    b = blocks(spark, [*HEAD, (1, 50, 100, "OA 1"), (1, 90, 102, "Medir el agua"), (1, 302, 95, "• Miden el agua con cuidado."), (1, 310, 110, "y anotan el valor."), (1, 302, 120, "• Comparan las medidas dadas."), (1, 302, 130, "• Comparan las medidas dadas."),
                       (1, 50, 200, "OA 2"), (1, 90, 202, "Leer el cuento"), (1, 302, 205, "• Leen el cuento completo."), (1, 302, 210, "12"), (1, 500, 205, "• Nota al margen de la página."), (2, 50, 10, "OA 9"), (1, 302, 215, None)])
    got = {r.code: (r.statement, r.indicators, r.joint) for r in layout.table_rows(b).collect()}
    assert got == {"1": ("OA 1 Medir el agua", ["Miden el agua con cuidado. y anotan el valor.", "Comparan las medidas dadas."], False), "2": ("OA 2 Leer el cuento", ["Leen el cuento completo."], False)}


def test_joint_rows(spark):
    b = blocks(spark, [(1, 50, 40, "Objetivos de Aprendizaje"), (1, 300, 40, "Indicadores de Evaluación"), (1, 50, 100, "OA 2: Medir el agua del lago"), (1, 50, 200, "OA c: Leer el cuento en voz alta"), (1, 302, 90, "• Miden el agua con cuidado."), (1, 302, 300, "• Leen el cuento completo.")])
    got = {r.code: (r.indicators, r.joint) for r in layout.table_rows(b).collect()}
    assert got == {k: (["Miden el agua con cuidado.", "Leen el cuento completo."], True) for k in ("2", "c")}
    assert layout.table_rows(b.limit(0)).count() == 0


def test_rows_from_text(spark):
    text = "Título\nObjetivos de Aprendizaje\nOA 3. Medir el agua\ndel lago.\nOA c: Leer el cuento.\nINDICADORES DE EVALUACIÓN\n• Miden el agua con cuidado.\n• Leen el cuen-\nto completo.\n• 12\nDURACIÓN\n• Otra cosa que no cuenta."
    df = spark.createDataFrame([("d", 1, text), ("d", 2, None), ("d", 3, "Objetivos de Aprendizaje OA 1. x"), ("d", 4, "")], "doc string, page int, text string")
    items = ["Miden el agua con cuidado.", "Leen el cuento completo."]
    assert [tuple(r) for r in layout.rows_from_text(df).collect()] == [("d", 1, "3", "Medir el agua del lago.", items), ("d", 1, "c", "Leer el cuento.", items)]


def test_median(spark):
    s = spark.createDataFrame([("d", 1, 5.0, 10), ("d", 1, 12.0, 5), ("d", 2, 8.0, 1), ("d", 2, 9.0, 1)], "doc string, page int, size double, n_chars int")
    assert {r.page: r["size"] for r in layout.median_size(s).collect()} == {1: 5.0, 2: 9.0}


def test_modules(spark):
    cap = "Aprendizajes esperados y criterios de evaluación"
    b = blocks(spark, [
        (1, 10, 10, "MÓDULO 1 · REPARAR MOTORES 228 Horas Tercero medio"), (1, 10, 20, cap), (1, 10, 30, "OA 4 Reparar los motores del taller"), (1, 10, 40, "1. Reparan los motores del taller."), (1, 200, 40, "1.1 Revisan el motor con cuidado."), (1, 300, 40, "B"), (1, 300, 45, "k"),
        (2, 10, 10, cap), (2, 200, 20, "1.2 Limpian las piezas del motor."), (2, 10, 30, "3."), (2, 60, 31, "Aplican técnicas de limpieza."), (2, 10, 60, "7."), (2, 200, 90, "76 Especialidad de mecánica"), (3, 10, 10, "Otro capítulo"), (4, 10, 10, cap), (4, 10, 20, "5. Esto no pertenece a nada."),
    ])
    ev = layout.module_events(b)
    got = {r.number: (r.module.number, r.module.hours, r.module.grade, r.statement, r.criteria, r.generic) for r in layout.learnings(ev).collect()}
    assert got == {1: (1, 228, "Tercero medio", "Reparan los motores del taller.", ["1.1 Revisan el motor con cuidado.", "1.2 Limpian las piezas del motor."], ["B", "K"]), 3: (1, 228, "Tercero medio", "Aplican técnicas de limpieza.", [], [])}
    assert ev.where("kind = 'objective'").count() == 1


def test_prose(spark):
    text = "Ideas:\n1. Una idea\nque sigue.\nPodrá:\nOA 1. Medir el agua (del lago) con\ncuidado. (Materia y energía)\nOA 2. Leer:\n• cuentos;\n- poemas\nlargos. (Lectura)\r\nOA 4. Sin eje."
    df = spark.createDataFrame([(1, text, 0), (2, None, 0), (3, "nada", 0)], "page_id int, text string, number int")
    got = [tuple(r) for r in prose.objectives(df).orderBy("number").collect()]
    assert got == [(1, 1, "Medir el agua (del lago) con cuidado.", "Materia y energía"), (1, 2, "Leer:\n- cuentos;\n- poemas largos.", "Lectura"), (1, 4, "Sin eje.", None)]
    assert {tuple(r) for r in prose.problems(prose.objectives(df)).collect()} == {(1, "numbers"), (1, "no strand")}
    assert [tuple(r) for r in prose.ideas(df).collect()] == [(1, 1, "Una idea que sigue.")]


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([(1, "A", 'di "x"\ny', "l1", "s", ["i", "j"]), (2, None, None, "l2", None, None)], "row_id int, code string, statement string, level_id string, subject string, indicators array<string>")
    assert [r.x for r in df.select(exports.csv_line([F.col("code"), F.col("statement")]).alias("x")).collect()] == ['"A","di ""x"" y"', '"",""']
    p = df.select(exports.prompt_block(F.col("code"), F.col("subject"), F.col("level_id"), F.lit("t"), F.lit("a:\n- b\n- c"), F.col("indicators")).alias("x")).collect()
    assert p[0].x == "[A] s · l1 · t\na:; b; c\nIndicadores: i j" and p[1].x == "[] l2 · t\na:; b; c"
    assert df.select(exports.plain_block(F.col("code"), F.lit("w"), F.lit("a\nb"), F.col("indicators")).alias("x")).first().x == "[A] a\n  b\n  w\nIndicadores de evaluación:\n  - i\n  - j"
    exports.write_by_level(df.select("level_id", "code"), str(tmp_path / "o"))
    assert sorted(r.level_id for r in spark.read.json(str(tmp_path / "o")).collect()) == ["l1", "l2"]


def test_streams(spark, tmp_path):
    schema = "id int, ts timestamp, k string"
    spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "id int, k string").withColumn("ts", F.lit("2024-01-01 10:00:00").cast("timestamp")).select("id", "ts", "k").write.parquet(str(tmp_path / "in"))
    s = ingest.without_repeats(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), ["id"], "ts")
    q = ingest.audited(s, lambda b: b.groupBy("k").count(), str(tmp_path / "out"), str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {(r.k, r["count"]) for r in spark.read.parquet(str(tmp_path / "out")).where("k IS NOT NULL").collect()} == {("a", 1), ("b", 1)}
