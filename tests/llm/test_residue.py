import pytest
from telarium.llm import residue as R

RESIDUE = {
    "slot": ["Docente: {{docente}}", "Unidad: [[UNIDAD]]", "Eje: «eje»", "Horas: null", "Curso: <curso>", "Nivel: [nivel]", "Fecha: __FECHA__", "Resumen: #resumen#", "Objetivo: POR DEFINIR", "Estimado {1}: la unidad {2} comienza el {3}.",
             "Curso: [PENDIENTE: curso]", "Eje: TODO: agregar eje", "Curso: Haga clic para agregar curso", "Titulo unidad: NOMBRE_DEL_titulo", "Horas: XXXXX", "Indicador: (completar indicador)", "Total: ${total}", "Nivel: %NIVEL%", "Nombre: &lt;nombre&gt;"],
    "error": ["La página solicitada no existe o cambió de lugar.", "Mapa del sitio 404 – Página no encontrada", "upstream did not answer in time", '{"status": 404, "message": "recurso inexistente", "data": null}', "EL SERVIDOR DE RECURSOS NO PUDO CARGARSE.", "Error 503", "Su sesión ha caducado. Inicie sesión otra vez.", "Compruebe que usted no es un robot para continuar."],
    "script": ["Para ver este contenido debe activar JavaScript en su navegador.", "<div>Please enable scripting first.</div>", "Este sitio necesita scripts para funcionar.", "JavaScript y cookies: desactivado. El contenido aparece al activarlo."],
    "filler": ["Lorem ipsum", "bla bla bla bla", "Texto de relleno para la maqueta.", "asdf asdf qwer asdf", "Loumqui samivel atrevel mitu saecum umne lolo neum ecat."],
}
CONTENT = [
    None, "", "  \n ", "Los estudiantes miden el agua.", "En la clase de Historia se explica qué significa un error 404 cuando una página no existe.", "En inglés se lee el aviso «page not found» y se traduce en parejas.",
    "Traduzca al inglés o al español: La página solicitada tardó demasiado en responder. Recargue la página.", 'Si aparece el mensaje "scripting: desactivado. El contenido aparece al activarlo.", el grupo avisa al docente.',
    "Se muestra cómo una plantilla usa {{nombre}} y cómo el programa lo cambia.", "Sea el conjunto {1, 2, 3}; escriba [a, b] como intervalo y 2 < x < 5.", "Complete la oración: el agua ______ porque ______.", "Nombre: ____________  Curso: ________  Fecha: ____/____",
    "En programación, null y undefined indican que una variable todavía no tiene valor.", "Cada grupo reemplaza ${curso} por su propio dato y describe la tabla.", "Lectura del cuento «Nube» y debate.", "Inicio | Currículo | Recursos | Contacto",
    "Los estudiantes discuten por qué algunos sitios piden activar JavaScript para mostrar un contenido.", "日月水火\nкит и лес\nΣ(n)\n½ taza",
]


@pytest.mark.parametrize("kind, text", [(k, t) for k, ts in RESIDUE.items() for t in ts])
def test_residue(kind, text):
    assert R.judge("Los estudiantes leen el cuento.\n" + text) == kind


@pytest.mark.parametrize("text", CONTENT)
def test_content(text):
    assert R.judge(text) is None


def test_documents(spark):
    texts = [t for ts in RESIDUE.values() for t in ts] + CONTENT + ["Los estudiantes leen. " * 20_000 + "\nLorem ipsum"]
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)] + [(0, texts[0], 2, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, reason int, line string")
    got = sorted(r.doc_id for r in R.residue(df).collect())
    n = sum(map(len, RESIDUE.values()))
    assert got == [*range(n), len(texts) - 1]  # a repeated id comes out once
    assert R.residue(df.limit(0)).count() == 0
    assert sorted(r.doc_id for r in R.residue(df.repartition(7)).collect()) == got  # whatever the tasks


def test_templates_share_wildcards_but_not_what_the_verdict_reads(spark):
    texts = [f"El recurso {w} no pudo cargarse." for w in ("uno", "dos", "tres", "nuevo", "viejo", "largo", "corto", "azul", "verde", "rojo", "gris", "rosa")] + [None, "Se lee el cuento del error."]
    got = {(r.template, r.n, r.verdict) for r in R.templates(spark.createDataFrame([(t,) for t in texts], "text string")).collect()}
    assert got == {(f"el recurso {R.WILD} no pudo cargarse.", 12, "error")}


def test_constants_come_from_the_whole_corpus(spark):
    """A token that a tenth of a leaf's messages has is a constant of its templates, whatever the tasks."""
    df = spark.createDataFrame([("El recurso no pudo cargarse.",)] * 5 + [(f"El {w} no pudo cargarse.",) for w in ("mapa", "cuento", "dibujo", "tema", "libro", "juego", "plan")], "text string")
    for parts in (1, 5):
        got = {(r.template, r.n) for r in R.templates(df.repartition(parts), min_count=1).collect()}
        assert got == {("el recurso no pudo cargarse.", 5), (f"el {R.WILD} no pudo cargarse.", 7)}


ALIKE = ["El recurso no está disponible por ahora", "El recurso ya está disponible por ahora", "La página que busca no existe o cambió de dirección", "La página que busca no existe ni cambió de dirección", "No pudo cargarse el documento", "No debe cargarse el documento"]


@pytest.mark.parametrize("texts", [ALIKE, ALIKE[::-1], ALIKE[2:] + ALIKE[:2]])
@pytest.mark.parametrize("parts", [1, 3])
def test_alike_messages_are_judged_apart_in_any_order(spark, texts, parts):
    df = spark.createDataFrame([(ALIKE.index(t), t) for t in texts], "doc_id long, text string").repartition(parts)
    assert sorted(r.doc_id for r in R.residue(df).collect()) == [0, 2, 4]


def test_the_verdict_of_a_shape_is_that_of_its_messages():
    for text in [t for ts in RESIDUE.values() for t in ts] + [t for t in CONTENT if t] + ALIKE:
        for m in R.parse(text)[0]:
            assert R.verdict(R.shape(m)) == R.verdict(m)


def test_rows_come_through_the_mined_templates(spark, monkeypatch):
    """Without a verdict of any template, no message is residue."""
    df = spark.createDataFrame([(1, "El recurso no pudo cargarse."), (2, "Docente: {{docente}}")], "doc_id long, text string")
    assert sorted(r.doc_id for r in R.residue(df).collect()) == [1, 2]
    real = R.mine
    monkeypatch.setattr(R, "mine", lambda found: (real(found)[0], real(found)[1].limit(0)))
    assert [r.doc_id for r in R.residue(df).collect()] == [2]


def test_a_message_of_many_documents(spark):
    df = spark.createDataFrame([(i, "Error 503" if i % 2 else f"Los estudiantes leen el cuento {i}.") for i in range(4000)], "doc_id long, text string")
    assert R.residue(df).count() == 2000


def test_text_in_another_language_is_no_filler(spark):
    assert R.judge("Gatto nero mangia pesce crudo domani.") is None
