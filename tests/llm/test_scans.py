import random

import pytest
from telarium.llm import scans as S

WORDS = "cuaderno ventana científico geográfica democrática presupuesto transformador ecológico matemático moderno torno estanque documento creativa grupal mercado oficio alimento".split()


@pytest.fixture(scope="module")
def reader():
    return S.Reader({w: 50 for w in WORDS} | {"causa-efecto": 20, "causa": 20, "efecto": 20, "el": 500, "de": 500, "la": 500})


@pytest.mark.parametrize("seen, printed", [
    ("ventan@", "ventana"), ("docurnento", "documento"), ("c1entífico", "científico"), ("presupucsto", "presupuesto"), ("fransformador", "transformador"), ("democra´tica", "democrática"), ("geogr�fica", "geográfica"), ("ecol?gico", "ecológico"),
    ("gnipal", None), ("griipal", "grupal"), ("modemo", "moderno"), ("cuaclerno", "cuaderno"), ("estanquc", "estanque"), ("oﬁcio", "oficio"), ("creati\\/a", "creativa"), ("ventana", None), ("Nikuvimel", None), ("zapato", None),
])
def test_links(reader, seen, printed):
    assert reader.correct(seen) == printed


def test_misread(reader):
    assert reader.misread("Nik1vimel") and not reader.misread("25") and not reader.misread("OA") and not reader.misread("m²") and not reader.misread("3M")


def test_divided(reader):
    assert reader.divided("docu", "mento", "-") and reader.divided("docu", "rnento", "-") and reader.divided("Niku", "vimel", "-")
    assert not reader.divided("causa", "efecto", "-") and reader.divided("causa", "efecto", "\xad")


def page():
    return "\n".join(["Bases del Valle", "Durante 4° Medio:", "1. El mercado moderno del docu-", "12 |", "Bases dcl Valle", "mento creativo.\r", "OA 1. La causa-", "efecto del estanque ecol0gico", "para el cuaclerno.", "12 |"])


def test_page(reader):
    noise, text = S.page_noise(page(), 12, [S.skeleton("Bases del Valle")], set(), reader)
    assert noise == [(0, "furniture"), (2, "hyphen"), (3, "furniture"), (4, "furniture"), (7, "char"), (8, "char"), (9, "furniture")]
    assert text == "Durante 4° Medio:\n1. El mercado moderno del documento creativo.\nOA 1. La causa-efecto del estanque ecológico para el cuaderno."


def test_item(reader):
    assert S.item_noise("1.2 Miden el docu-  mento moderno. 68 | HISTORIA", {S.skeleton("7 | HISTORIA")}, reader) == (["furniture", "hyphen"], "1.2 Miden el documento moderno.")
    strips = {S.skeleton("Programa de Estudio Historia 7")}
    assert S.item_noise("Programa de Estudio Historia 148 Miden el mcrcado - con la ventana.", strips, reader)[0] == ["char", "furniture"]
    assert S.item_noise("Miden el mercado de modo causa-efecto - con la ventana.", strips, reader) == ([], "Miden el mercado de modo causa-efecto - con la ventana.")


def corpus():
    r = random.Random(8)
    say = lambda: f"El {r.choice(WORDS)} {r.choice(WORDS)} de la {r.choice(WORDS)} {r.choice(WORDS)} del {r.choice(WORDS)}."
    pages, want = [], set()
    for i in range(60):
        lines = [f"Cuadernillo {'Norte' if i % 2 else 'Sur'}", str(100 + i)] if i < 40 else []
        want |= {("bases_pages", i, k, "furniture") for k in range(len(lines))}
        for _ in range(6):
            w = say()
            if i < 40 and r.random() < 0.3:
                w = w.replace("a", "@", 1) if "a" in w else w
                if "@" in w:
                    want.add(("bases_pages", i, len(lines), "char"))
            lines.append(w)
        if i < 40:
            lines += ["Horas sugeridas", str(r.randint(1, 40))]
        pages.append((i, f"f{i // 20}", 100 + i, "\n".join(lines), "x"))
    return pages, want


def test_whole(spark):
    pages, want = corpus()
    df = spark.createDataFrame(pages + [(900, "f0", 1, None, None), (901, "f0", 1, "", None), (902, None, None, "El mercado.", None)], "page_id long, source_pdf string, pdf_page int, text string, noise string")
    items = spark.createDataFrame([(1, ["El mercado moderno.", None, "", "El mer-  cado moderno."]), (2, None), (3, []), (4, ["El mcrcado moderno. Página 12"])], "row_id long, indicators array<string>")
    got = S.read(df, [("table_rows", items, "row_id", "indicators")])
    found = {tuple(r) for r in S.found(got).collect()}
    expected = want | {("table_rows", 1, 3, "hyphen"), ("table_rows", 4, 0, "char"), ("table_rows", 4, 0, "furniture")}
    assert found == expected
    text = {(r.table_name, r.row_id, r.pos): r.text for r in S.repaired(got).collect()}
    assert text["table_rows", 1, 3] == "El mercado moderno." and text["table_rows", 4, 0] == "El mercado moderno." and "Cuadernillo" not in text["bases_pages", 0, -1] and ("bases_pages", 900, -1) not in text


def test_empty(spark):
    none = spark.createDataFrame([], "page_id long, source_pdf string, pdf_page int, text string")
    items = spark.createDataFrame([], "row_id long, indicators array<string>")
    assert S.read(none, [("table_rows", items, "row_id", "indicators")]).count() == 0


def test_long_page(reader):
    text = "\n".join(["El mercado moderno del estanque grupal."] * 3000 + ["el docu-", "mento"])
    noise, out = S.page_noise(text, 1, [], set(), reader)
    assert noise == [(3000, "hyphen")] and out.endswith("documento")


def test_vectors_place_words_of_one_context_together(spark):
    r = random.Random(1)
    a, b = ["perro", "gato", "caballo", "zorro"], ["rojo", "verde", "azul", "negro"]
    texts = [(f"el {r.choice(a)} come pan y el cielo es {r.choice(b)} hoy",) for _ in range(800)]
    df = spark.createDataFrame(texts, "text string")
    v = S.skip_grams(df, S.vocabulary(S.words_of(df)))
    import numpy as np

    cos = lambda x, y: float(v[x] @ v[y] / np.linalg.norm(v[x]) / np.linalg.norm(v[y]))
    assert cos("perro", "gato") > cos("perro", "azul") + 0.2 and cos("rojo", "verde") > cos("rojo", "zorro") + 0.2


def test_counts_do_not_depend_on_the_size(spark, monkeypatch):
    """Words under the share that is kept in memory have their true counts."""
    df = spark.createDataFrame([("mercado " * 70 + "ñandú " * 9 + "zona " * 5,), ("mercadc " * 60 + "uno " * 3 + "el " * 3000,)], "text string")
    want = {"mercado": 70, "ñandú": 9, "zona": 5, "mercadc": 60, "el": 3000}
    words = S.words_of(df)
    assert S.vocabulary(words) == {w: str(n) for w, n in want.items()}
    monkeypatch.setattr(S, "SHARE", 0.1)  # as in a corpus of many words
    v = S.vocabulary(words)
    assert dict.keys(v) == {"el"} and {w: v.get(w) for w in want} == want
    assert "uno" not in v and v.get("zzz", 0) == 0 and v.get("", 0) == 0 and v.get("a", 0) == 0
    assert S.Reader(v).link("mercadc") == () and S.Reader(v).link("zon@") == ("zona",)
    links = S.linked(words.unionByName(spark.createDataFrame([("zon@", 1), ("mcrcado", 1)], "w string, n long")), v, None)
    assert links.get("zon@") == "zona" and links.get("mcrcado") == "mercado" and links.get("mercado") is None
    assert S.Reader(v, None, links).correct("mcrcado") == "mercado" and S.Reader(v, None, links).correct("mercad0") is None  # made for the words of the texts
    items = spark.createDataFrame([("Miden el agua. HISTORIA 7",)] * 2 + [("Leen. LENGUA 8",)] + [("Miden el agua.",)] * 97, "text string")
    strips = S.item_strips(items)
    assert S.skeleton("HISTORIA 7") in strips and S.skeleton("LENGUA 8") not in strips


def test_strips_of_any_place_and_length(reader):
    far = " ".join(["Miden el mercado"] * 20)
    strip = "Programa de Estudio de la Historia del Mercado y del Oficio 7"
    for s in (strip, "HISTORIA 7"):
        seen = s.replace("7", "148")
        assert S.item_noise(f"{far} {seen} con la ventana.", {S.skeleton(s)}, reader) == (["furniture"], f"{far} con la ventana.")
    part = "El Rn 3. • (años) 5º\u00a0B12 ﬁn—Σ de cl|a´, l1 “x”"
    assert S.skeleton(part) == " ".join(filter(None, map(S.skeleton, part.split())))


def test_long_running_lines(spark):
    head = "Programa de Estudio de Historia, Geografía y Ciencias Sociales para la Educación Media de todo el país"
    assert len(head) > 90
    pages = spark.createDataFrame([(i, "a.pdf", i, f"{head}\nTexto {chr(97 + i)} propio.\n{chr(97 + i) * 100}.") for i in range(6)], "page_id long, source_pdf string, pdf_page int, text string")
    assert [r.furniture for r in S.furniture(S.page_lines(pages), pages).collect()] == [[S.skeleton(head)]]


def contexts(spark, n=600):
    r = random.Random(2)
    texts = [(f"la {r.choice(['cuenta', 'plaza', 'tarea'])} nueva y el {r.choice(['cuento', 'puente', 'tambor'])} nuevo" if r.random() < 0.5 else f"el {r.choice(['cuento', 'puente'])} viejo con la {r.choice(['cuenta', 'tarea'])} vieja",) for _ in range(n)]
    df = spark.createDataFrame(texts, "text string")
    words = S.words_of(df)
    v = S.vocabulary(words)
    return df, v, S.skip_grams(df, v)


def test_context_decides_between_neighbours(spark):
    """The same misread word is another one in another context; counts alone would give one answer."""
    _, v, vectors = contexts(spark)
    r, alone = S.Reader(v, vectors), S.Reader(v)
    fixed = [(r.fix(t), alone.fix(t)) for t in ("la cuent@ nueva", "el cuent@ nuevo")]
    assert [a for a, _ in fixed] == ["la cuenta nueva", "el cuento nuevo"]
    assert len({b.split()[1] for _, b in fixed}) == 1


def test_rare_words_have_vectors_and_link_to_near_words_only(spark):
    _, v, vectors = contexts(spark)
    assert "tarnbor" not in vectors and vectors["tarnbor"].any() and vectors.near("tarnbor", "tambor") > S.NEAR
    r = S.Reader(v, vectors)
    assert r.link("tarnbor") == ("tambor",)
    far = S.Vectors({w: x for w, x in vectors.own.items()}, -vectors.grams, vectors.contexts)
    far.own["tambor"] = vectors["tambor"]  # now it is far from its own n-grams
    assert S.Reader(v, far).link("tarnbor") == ()


def test_digits_behind_the_last_point_are_no_furniture_unless_they_repeat(reader):
    for text in ("Los estudiantes leen textos. En grupos de 4", "Resuelven problemas con números. Por ejemplo 3 + 4"):
        assert S.item_noise(text, {S.skeleton("HISTORIA 7")}, reader) == ([], text)
    assert S.item_noise("Leen textos. Página 12", set(), reader) == (["furniture"], "Leen textos.")
    long = "Programa de Estudio de la Historia del Mercado y del Oficio de todo el país para la Educación Media 7"
    assert S.item_noise(f"Leen textos. {long.replace('7', '148')}", {S.skeleton(long)}, reader)[0] == ["furniture"]


def test_each_occurrence_has_its_own_context(spark):
    _, v, vectors = contexts(spark)
    assert S.Reader(v, vectors).fix("la cuent@ nueva y el cuent@ nuevo") == "la cuenta nueva y el cuento nuevo"


def test_endless_tokens(reader):
    assert S.item_noise("1l" * 20_000, set(), reader)[1] == "1l" * 20_000


def test_a_line_that_continues_and_divides_a_word(reader):
    noise, text = S.page_noise("El docu-\nmento del merca-\ndo grupal", 1, [], set(), reader)
    assert noise == [(0, "hyphen"), (1, "hyphen")] and text == "El documento del mercado grupal"
