"""Queries of the readers and of functions without a table of their own, with their SQL.

The readers' inputs (pages as HTML, layouts as blocks, texts of pages) are made from the tables, one page for each row, so what a reader
gets back must be the rows again; the SQL says what they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telarium.functions import text as T
from telarium.operators import audits, dimensions, merging, ordering, search
from telarium.plans import exports
from telarium.queries import _CODE_RE, _FOLD, _JOINED, _NORM, _PARSED, _SLUG, _with_offering, objectives, query
from telarium.session import table
from telarium.sources import layout, pages

_SITE = "https://curriculo.example"
_WS = r"[\s\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


class _Sql(str):
    """SQL with a place {0}; other braces are those of patterns."""

    def format(self, x: str) -> str:
        return self.replace("{0}", x)


_FLAT = _Sql("regexp_replace(regexp_replace({0}, '" + _WS + "', ' ', 'g'), '^ +| +$', '', 'g')")
_CLEAN = _Sql(_FLAT.format("regexp_replace(replace({0}, chr(173), ''), '([\\p{L}\\p{M}\\p{N}_])-\\s*\\n\\s*([\\p{L}\\p{M}\\p{N}_])', '\\1\\2', 'g')"))
_DECORATION = _Sql("(trim({0}) = '' OR regexp_matches(trim({0}), '(?i)^(?:U\\s*\\d+|UNIDAD\\s*\\d+|EJE\\b.*|\\d+|[IVX]+|Pág\\.?\\s*\\d+)$') OR regexp_matches({0}, '(?i)indicadores\\s+de\\s+evaluaci|objetivos\\s+de\\s+aprendizaje') OR regexp_matches(lower(trim({0})), '^(?:se espera que|los estudiantes que|las y los estudiantes que|los y las estudiantes que|el estudiante que)'))")


def _text(c: str | Column) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


# ---- pages ----------------------------------------------------------------------------------------------------------

_TITLES = {"habilidad": "Objetivo de Aprendizaje de Habilidad", "actitud": "Objetivo de Aprendizaje de Actitud"}


def objective_pages(raw: DataFrame) -> DataFrame:
    """(url, html): a page for each row of raw_objectives, in the site's markup."""
    e = lambda c: T.escape_html(_text(c))
    title = F.concat(F.when(F.col("category") == "habilidad", _TITLES["habilidad"]).when(F.col("category") == "actitud", _TITLES["actitud"]).otherwise("Objetivo de Aprendizaje"), F.lit(" "), e("code"))
    lines = F.transform(F.split(_text("statement"), "\n"), lambda x: F.when(x.startswith("- "), F.concat(F.lit("<li>"), T.escape_html(F.substring(x, 3, 1 << 20)), F.lit("</li>"))).otherwise(F.concat(F.lit("<p>"), T.escape_html(x), F.lit("</p>"))))
    strand = F.when(F.col("strand_name").isNotNull(), F.concat(F.lit('<h3 id="'), _text("strand_kind"), F.lit("-1--"), _text("strand_term_id"), F.lit('">'), e("strand_name"), F.lit("</h3>"))).otherwise("")
    html = F.concat(
        F.lit('<html><body><div class="items-wrapper">'), strand, F.lit('<div class="item-wrapper'), F.when(F.col("prioritized"), " prioritized").otherwise(""), F.lit('"><span class="oa-title">'), title,
        F.lit('</span><span class="number-title">'), e("code"), F.lit('</span><div class="field--name-description">'), F.array_join(lines, ""), F.lit("</div>"),
        F.when(F.col("detail_url").isNotNull(), F.concat(F.lit('<a class="link-more" href="'), F.col("detail_url"), F.lit('">más</a>'))).otherwise(""), F.lit("</div></div></body></html>"),
    )
    return raw.select(F.concat(F.lit(f"{_SITE}/curriculum/base/"), F.col("subject_slug"), F.lit("/"), F.col("grade_slug"), F.lit("?n="), "row_id").alias("url"), html.alias("html"))


@query("page_objectives", f"""
WITH l AS (SELECT *, list_filter(list_transform(string_split(coalesce(statement, ''), chr(10)), lambda x: CASE WHEN starts_with(x, '- ') THEN CASE WHEN {_FLAT.format('substr(x, 3)')} <> '' THEN '- ' || {_FLAT.format('substr(x, 3)')} ELSE '' END ELSE {_FLAT.format('x')} END), lambda x: x <> '') AS ls FROM raw_objectives)
SELECT '{_SITE}/curriculum/base/' || subject_slug || '/' || grade_slug || '?n=' || row_id AS url, {_FLAT.format('code')} AS code, array_to_string(list_filter(ls, lambda x, i: i = 1 OR x <> ls[i - 1]), chr(10)) AS statement, category,
  {_FLAT.format('strand_name')} AS strand_name, CASE WHEN strand_name IS NOT NULL THEN CASE strand_kind WHEN 'eje' THEN 'Eje' WHEN 'nucleo' THEN 'Núcleo' WHEN 'habilidad' THEN 'Habilidad' END END AS strand_kind,
  CASE WHEN strand_name IS NOT NULL THEN strand_term_id END AS strand_term_id, prioritized, detail_url, 1 AS position FROM l""")
def page_objectives(spark, d):
    x = pages.objectives(pages.read_pages(objective_pages(table(spark, d, "raw_objectives"))))
    return x.select("url", "code", "statement", "category", "strand_name", "strand_kind", "strand_term_id", "prioritized", "detail_url", "position")


def _offering_pages(spark, d) -> DataFrame:
    """A page for each offering with its path, filters, documents and links to the other subjects of its level."""
    o = table(spark, d, "offerings")
    e = lambda c: T.escape_html(_text(c))
    path = lambda subject, level: F.concat(F.lit("/curriculum/base/"), F.replace(subject, F.lit("_"), F.lit("-")), F.lit("/"), F.replace(level, F.lit("_"), F.lit("-")))
    html = F.concat(
        F.lit('<ol class="breadcrumb"><li>Inicio</li><li>Currículum</li><li>'), e("track"), F.lit("</li><li>"), e("subject_name"), F.lit("</li></ol><h1>"), e("subject_name"), F.lit(" "), e("level_name"),
        F.lit('</h1><a class="link-button-more" href="/r?field_cn_subjects='), _text("subject_id"), F.lit("&amp;field_cn_grades="), _text("level_id"), F.lit('">x</a><a class="link-button-more" href="/b?f[0]=bases%3A'), F.length("subject_id"),
        F.lit('">y</a><div class="documents-wrapper"><article><span class="badge">'), e("curriculum_status"), F.lit('</span><h3><a href="/docs/'), _text("subject_id"), F.lit('.pdf">Programa de '), e("subject_name"), F.lit('</a></h3></article><article><h3>sin enlace</h3></article></div><a href="'),
        path(F.col("subject_id"), F.lit("1_medio")), F.lit('?x=1">l</a><a href="/curriculum/base/curso/1-medio">n</a><a href="/otra/cosa">m</a>'),
    )
    return o.select("offering_key", F.concat(F.lit(_SITE), path(F.col("subject_id"), F.col("level_id"))).alias("url"), html.alias("html"))


_PATH = "'/curriculum/base/' || replace(subject_id, '_', '-') || '/' || replace({0}, '_', '-')"


@query("page_heads", f"""
SELECT '{_SITE}' || {_PATH.format('level_id')} AS url, 'base' AS base_slug, replace(subject_id, '_', '-') AS subject_slug, replace(level_id, '_', '-') AS grade_slug, subject_name || ' ' || level_name AS page_title,
  coalesce(track, '') AS base_name, subject_name, subject_id AS source_subject_id, level_id AS source_grade_id, length(subject_id)::VARCHAR AS source_base_id FROM offerings""")
def page_heads(spark, d):
    return pages.read_pages(_offering_pages(spark, d)).drop("documents", "objectives")


@query("page_documents", f"SELECT '{_SITE}' || {_PATH.format('level_id')} AS page_url, 0 AS ord, nullif(curriculum_status, '') AS doc_type, 'Programa de ' || subject_name AS title, '{_SITE}/docs/' || subject_id || '.pdf' AS url FROM offerings")
def page_documents(spark, d):
    return pages.documents(pages.read_pages(_offering_pages(spark, d)))


@query("page_links", f"SELECT '{_SITE}' || {_PATH.format('level_id')} AS page_url, {_PATH.format(chr(39) + '1_medio' + chr(39))} AS path FROM offerings")
def page_links(spark, d):
    return pages.links(_offering_pages(spark, d))


@query("page_sectors", """
WITH a AS (SELECT *, row_number() OVER (PARTITION BY track ORDER BY level_id, subject_id) AS n FROM offerings), k AS (SELECT *, row_number() OVER (PARTITION BY track, subject_id ORDER BY n) AS k FROM a WHERE level_id LIKE '%medio')
SELECT track AS doc, subject_id AS slug, level_id AS sector FROM k WHERE k = 1""")
def page_sectors(spark, d):
    o = ordering.position_in_group(table(spark, d, "offerings"), ["track"], ["level_id", "subject_id"], "n")
    a = o.select(F.col("track").alias("doc"), F.explode(F.array(F.struct((F.col("n") * 2).alias("pos"), F.lit("heading").alias("kind"), F.col("level_id").alias("value")), F.struct((F.col("n") * 2 + 1).alias("pos"), F.lit("link").alias("kind"), F.col("subject_id").alias("value")))).alias("x"))
    return pages.sectors(a.select("doc", "x.*"), [f"{i}_medio" for i in range(1, 5)] + ["epja_media"])


# ---- layouts --------------------------------------------------------------------------------------------------------

_ITEMS = f"""
WITH i AS (SELECT row_id, coalesce(joint, false) AS joint, statement, ((row_id % 30) + 1)::VARCHAR AS code, unnest(indicators) AS x, generate_subscripts(indicators, 1) AS nth FROM table_rows),
c AS (SELECT *, {_CLEAN.format('x')} AS item FROM i WHERE x IS NOT NULL),
g AS (SELECT row_id, joint, code, statement, list(item ORDER BY nth) FILTER (WHERE length(item) >= 12 AND NOT {_DECORATION.format('item')}) AS ls FROM c GROUP BY ALL)"""
_DISTINCT = "list_filter(ls, lambda x, i: list_position(ls, x) = i)"


def table_blocks(rows: DataFrame) -> DataFrame:
    """(doc, page, ord, x0, y0, text): a page for each row of table_rows, in two columns; joint rows without the caption of single ones."""
    code = ((F.col("row_id") % 30) + 1).cast("string")
    b = lambda x, y, t, o: F.struct(F.lit(o).cast("int").alias("ord"), F.lit(float(x)).alias("x0"), (y if isinstance(y, Column) else F.lit(float(y))).cast("double").alias("y0"), t.alias("text"))
    joint = F.coalesce("joint", F.lit(False))
    fixed = [
        b(50, 40, F.lit("Objetivos de Aprendizaje"), 0), b(300, 40, F.lit("Indicadores de Evaluación"), 1), b(300, 55, F.when(~joint, "Se espera que los estudiantes sean capaces de:"), 2),
        b(50, 100, F.when(joint, F.concat(F.lit("OA "), code, F.lit(": "), _text("statement"))).otherwise(F.concat(F.lit("OA "), code)), 3), b(90, 102, F.when(~joint, F.col("statement")), 4), b(300, 110, F.lit("12"), 5),
    ]
    items = F.transform(F.coalesce("indicators", F.array().cast("array<string>")), lambda x, i: F.struct((i + 10).cast("int").alias("ord"), F.lit(302.0).alias("x0"), (F.lit(105.0) + i * 12).cast("double").alias("y0"), F.concat(F.lit("• "), x).alias("text")))
    return rows.select(F.col("row_id").cast("string").alias("doc"), F.lit(1).alias("page"), F.explode(F.concat(F.array(*fixed), items)).alias("b")).select("doc", "page", "b.*")


@query("layout_rows", f"{_ITEMS} SELECT row_id::VARCHAR AS doc, code, array_to_string({_DISTINCT}, '|') AS indicators, joint, CASE WHEN NOT joint THEN left('OA ' || code || coalesce(' ' || nullif({_CLEAN.format('statement')}, ''), ''), 400) ELSE left({_CLEAN.format(chr(39) + 'OA ' + chr(39) + ' || code || ' + chr(39) + ': ' + chr(39) + ' || coalesce(statement, ' + chr(39) * 2 + ')')}, 400) END AS statement FROM g WHERE len(ls) > 0 AND NOT (joint AND {_CLEAN.format('coalesce(statement, ' + chr(39) * 2 + ')')} = '')")
def layout_rows(spark, d):
    return layout.table_rows(table_blocks(table(spark, d, "table_rows"))).select("doc", "code", F.array_join("indicators", "|").alias("indicators"), "joint", "statement")


@query("layout_text_rows", f"{_ITEMS} SELECT row_id::VARCHAR AS doc, code, {_CLEAN.format('coalesce(statement, ' + chr(39) * 2 + ')')} AS statement, array_to_string({_DISTINCT}, '|') AS indicators FROM g WHERE len(ls) > 0")
def layout_text_rows(spark, d):
    items = F.filter("indicators", lambda x: x.isNotNull())
    text = F.concat(F.lit("Objetivos de Aprendizaje\nOA "), ((F.col("row_id") % 30) + 1).cast("string"), F.lit(". "), _text("statement"), F.lit("\nIndicadores de Evaluación\n"), F.array_join(F.transform(items, lambda x: F.concat(F.lit("• "), x)), "\n"), F.lit("\nDURACIÓN\n• Otra cosa que no cuenta."))
    x = table(spark, d, "table_rows").where(F.col("indicators").isNotNull()).select(F.col("row_id").cast("string").alias("doc"), F.lit(1).alias("page"), text.alias("text"))
    return layout.rows_from_text(x).select("doc", "code", "statement", F.array_join("indicators", "|").alias("indicators"))


def module_blocks(rows: DataFrame) -> DataFrame:
    """Blocks of a module's page for each row of expected_learnings: header, caption, the learning with as many criteria as the row has, its letters."""
    b = lambda y, x, t: F.struct(F.lit(float(x)).alias("x0"), F.lit(float(y)).alias("y0"), t.alias("text"))
    n = F.col("number").cast("string")
    head = F.concat(F.lit("MÓDULO "), F.col("module_number"), F.lit(" · "), F.upper(_text("module_name")), F.lit(" "), F.coalesce(F.col("hours"), F.lit(76)), F.lit(" Horas Tercero medio"))
    criteria = F.transform(F.coalesce("criteria", F.array().cast("array<string>")), lambda _, i: F.struct(F.lit(200.0).alias("x0"), (F.lit(60.0) + i).cast("double").alias("y0"), F.concat(n, F.lit("."), (i + 1).cast("string"), F.lit(" "), _text("statement")).alias("text")))
    letters = F.transform(F.coalesce("generic_objectives", F.array().cast("array<string>")), lambda g, i: F.struct(F.lit(300.0).alias("x0"), (F.lit(90.0) + i).cast("double").alias("y0"), F.lower(g).alias("text")))
    all_ = F.concat(F.array(b(10, 10, head), b(20, 10, F.lit("Aprendizajes esperados y criterios de evaluación")), b(30, 10, F.concat(n, F.lit(". "), _text("statement")))), criteria, letters)
    return rows.where("number IS NOT NULL").select(F.col("row_id").cast("string").alias("doc"), F.lit(1).alias("page"), F.posexplode(all_).alias("ord", "b")).select("doc", "page", "ord", "b.*")


_LEARNED = f"""(SELECT row_id, module_number, number, coalesce(hours, 76) AS hours, criteria, generic_objectives, {_CLEAN.format("coalesce(statement, '')")} AS s FROM expected_learnings WHERE number BETWEEN 1 AND 30)"""
_SAID = f"length(s) >= 12 AND NOT {_DECORATION.format('s')}"


@query("layout_learnings", f"""
SELECT row_id::VARCHAR AS doc, module_number AS module, hours, number, s AS statement, coalesce(array_to_string(list_transform(range(1, len(criteria) + 1), lambda i: number || '.' || i || ' ' || s), '|'), '') AS criteria,
  coalesce(array_to_string(list_distinct(list_transform(list_filter(generic_objectives, lambda g: regexp_full_match(g, '[A-Za-z]')), lambda g: upper(g))).list_sort(), ''), '') AS generic FROM {_LEARNED} WHERE {_SAID}""")
def layout_learnings(spark, d):
    x = layout.learnings(layout.module_events(module_blocks(table(spark, d, "expected_learnings"))))
    return x.select("doc", F.col("module.number").alias("module"), F.col("module.hours").alias("hours"), "number", "statement", F.array_join("criteria", "|").alias("criteria"), F.array_join(F.array_sort("generic"), "").alias("generic"))


@query("layout_median_size", """
WITH c AS (SELECT l_returnflag AS doc, l_linenumber AS page, l_quantity AS size, sum(l_orderkey % 7) AS n FROM lineitem WHERE l_orderkey % 7 > 0 GROUP BY ALL), s AS (SELECT *, sum(n) OVER (PARTITION BY doc, page ORDER BY size) - n AS before, sum(n) OVER (PARTITION BY doc, page) AS total FROM c)
SELECT doc, page, size FROM s WHERE before <= total // 2 AND total // 2 < before + n""")
def layout_median_size(spark, d):
    return layout.median_size(table(spark, d, "lineitem").select(F.col("l_returnflag").alias("doc"), F.col("l_linenumber").alias("page"), F.col("l_quantity").alias("size"), (F.col("l_orderkey") % 7).alias("n_chars")))


# ---- text functions -------------------------------------------------------------------------------------------------


@query("text_cells", f"""
SELECT row_id, nth - 1 AS position, {_CLEAN.format('x')} AS clean, regexp_matches(x, '^\\s*(?:•|›|>>|‣|●|·)\\s*') AS bullet, trim(regexp_replace(x, '^\\s*(?:•|›|>>|‣|●|·)\\s*', ''), ' ') AS body, {_DECORATION.format('x')} AS decoration, length(trim(x, ' ')) < 12 OR {_DECORATION.format('x')} AS furniture
FROM (SELECT row_id, unnest(indicators) AS x, generate_subscripts(indicators, 1) AS nth FROM table_rows) WHERE x IS NOT NULL""")
def text_cells(spark, d):
    x = table(spark, d, "table_rows").select("row_id", F.posexplode("indicators").alias("position", "x")).where("x IS NOT NULL")
    c = F.col("x")
    return x.select("row_id", F.col("position").cast("long").alias("position"), T.clean_extracted(c).alias("clean"), T.is_bullet(c).alias("bullet"), T.strip_bullet(c).alias("body"), T.is_decoration(c).alias("decoration"), T.is_furniture(c).alias("furniture"))


_CUT = _Sql("regexp_replace(regexp_replace(regexp_replace({0}, '•|›|>>|‣|●', chr(1), 'g'), '>(\\s+[A-ZÁÉÍÓÚÑ])', chr(1) || '\\1', 'g'), '(^|[^\\p{L}\\p{M}])ú(\\s)', '\\1' || chr(1) || '\\2', 'g')")


@query("text_bullets", f"""
WITH p AS (SELECT page_id, string_split({_CUT.format('text')}, chr(1)) AS ps FROM bases_pages WHERE text IS NOT NULL)
SELECT page_id, array_to_string(list_filter(list_transform(CASE WHEN len(ps) > 1 THEN ps[2:] ELSE ps END, lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> ''), '|') AS items FROM p""")
def text_bullets(spark, d):
    return table(spark, d, "bases_pages").where("text IS NOT NULL").select("page_id", F.array_join(T.split_bullets(F.col("text")), "|").alias("items"))


@query("code_candidates", """
SELECT row_id, CASE WHEN regexp_full_match(p, '\\d+') THEN 'conocimiento|' || p::INT || ',habilidad|' || p::INT || ',actitud|' || p::INT WHEN regexp_matches(p, '[a-z]') AND lower(p) = p THEN 'habilidad|' || p || ',actitud|' || upper(p) ELSE 'actitud|' || p || ',habilidad|' || lower(p) END AS keys
FROM (SELECT row_id, trim(regexp_replace(code, '^OA[A-Z]?\\s*|[.]$', '', 'g'), ' ') AS p FROM table_rows WHERE code IS NOT NULL)""")
def code_candidates(spark, d):
    printed = F.regexp_replace("code", r"^OA[A-Z]?\s*|[.]$", "")
    return table(spark, d, "table_rows").where("code IS NOT NULL").select("row_id", F.array_join(T.code_candidates(printed), ",").alias("keys"))


@query("classified", "SELECT row_id, CASE WHEN starts_with(t, 'oah') THEN 'habilidad' WHEN starts_with(t, 'oaa') THEN 'actitud' ELSE 'conocimiento' END AS category FROM (SELECT row_id, lower(regexp_extract(code, 'OA.*$')) AS t FROM objectives WHERE code IS NOT NULL)")
def classified(spark, d):
    return objectives(spark, d).where("code IS NOT NULL").select("row_id", T.classify(F.regexp_extract("code", "OA.*$", 0)).alias("category"))


_TWO = "CASE WHEN {0} > 99 THEN {0}::VARCHAR ELSE lpad({0}::VARCHAR, 2, '0') END"
_SUFFIX = f"CASE WHEN length(letters) = 1 AND digits IS NULL THEN upper(letters) WHEN length(letters) > 0 AND digits IS NOT NULL THEN upper(letters) || {_TWO.format('digits')} ELSE {_TWO.format('oa_number')} END"
_ABBR = "(SELECT upper(CASE WHEN len(ws) = 0 THEN 'XXX' WHEN len(ws) > 1 THEN left(array_to_string(list_transform(ws, lambda x: left(x, 1)), ''), 4) ELSE left(CASE WHEN length(sq) >= 3 THEN sq ELSE ws[1] END, 4) END) FROM (SELECT ws, left(ws[1], 1) || regexp_replace(substr(ws[1], 2), '[aeiou]', '', 'g') AS sq FROM (SELECT list_filter(string_split_regex({0}, '[^a-z0-9]+'), lambda x: x <> '') AS ws)))"


@query("canonical_ids", f"""
SELECT row_id, suffix_id, concat_ws('_', 'CL', subject_id, level_id, CASE WHEN lower(strand_kind) IN ('eje', 'nucleo', 'núcleo', 'modulo', 'módulo', 'ambito', 'ámbito', 'unidad') AND strand_eje IS NOT NULL THEN {_ABBR.format(_SLUG.format('strand_eje', '-'))} END,
  CASE category WHEN 'conocimiento' THEN 'OA' WHEN 'habilidad' THEN 'OAH' WHEN 'actitud' THEN 'OAA' END || suffix_id) AS id
FROM (SELECT p.row_id, o.subject_id, o.level_id, o.strand_kind, o.strand_eje, o.category, {_SUFFIX.replace('oa_number', 'p.oa_number')} AS suffix_id FROM ({_PARSED}) p JOIN objectives o USING (row_id))""")
def canonical_ids(spark, d):
    c, n = F.col("code"), F.col("oa_number")
    return objectives(spark, d).select("row_id", T.id_suffix(c, n).alias("suffix_id"), T.canonical_id("CL", F.col("subject_id"), F.col("level_id"), F.col("category"), c, n, F.col("strand_eje"), F.col("strand_kind")).alias("id"))


_HEX = "('0x' || substr(sha1(subject_id), {0}, 8))::UBIGINT"


@query("slug_fingerprints", "SELECT DISTINCT subject_id, " + " || ".join(f"substr('ABCDEFGHJKLMNPQRSTUVWXYZ23456789', ((({_HEX.format(9 if i < 6 else 1)}) >> {5 * i if i < 6 else 5 * i - 32}) & 31)::INT + 1, 1)" for i in range(4)) + " AS fingerprint FROM offerings")
def slug_fingerprints(spark, d):
    return table(spark, d, "offerings").select("subject_id").distinct().select("subject_id", T.slug_fingerprint(F.col("subject_id")).alias("fingerprint"))


_ESCAPED = "replace(replace(replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#39;')"


@query("text_escaped", f"SELECT doc_id, {_ESCAPED.format('text')} AS html, regexp_replace(source_url, '^http://', 'https://') AS url FROM documents")
def text_escaped(spark, d):
    return table(spark, d, "documents").select("doc_id", T.escape_html(F.col("text")).alias("html"), T.https(F.col("source_url")).alias("url"))


# ---- dimensions, cookbook, exports ------------------------------------------------------------------------------------


@query("level_tokens", "SELECT level_id, CASE WHEN level_id LIKE '%_medio' THEN '1_MEDIO,2_MEDIO,3_MEDIO,4_MEDIO' ELSE upper(level_id) END AS levels FROM (SELECT DISTINCT level_id FROM offerings)")
def level_tokens(spark, d):
    medio = [f"{i}_MEDIO" for i in range(1, 5)]
    x = table(spark, d, "offerings").select("level_id").distinct().withColumn("tokens", F.array(F.when(F.col("level_id").endswith("_medio"), "media ").otherwise(F.col("level_id")), F.when(F.col("level_id").endswith("_medio"), F.col("level_id")).otherwise(F.col("level_id"))))
    known = [r.level_id.upper() for r in table(spark, d, "offerings").select("level_id").distinct().collect()]
    return dimensions.expand_tokens(x, "tokens", {"MEDIA": medio}, known).select("level_id", F.array_join("levels", ",").alias("levels"))


@query("transversal_ids", f"""
WITH p AS (SELECT source_pdf, module_number, module_name, {_SLUG.format('module_name', '_')} AS slug, count(*) AS n FROM expected_learnings WHERE module_name IS NOT NULL GROUP BY ALL),
b AS (SELECT *, row_number() OVER (PARTITION BY source_pdf, slug ORDER BY n DESC, module_number, module_name) AS k FROM p),
c AS (SELECT e.*, b.slug FROM expected_learnings e JOIN b ON b.k = 1 AND e.source_pdf = b.source_pdf AND e.module_number = b.module_number AND e.module_name = b.module_name),
n AS (SELECT *, coalesce(number, row_number() OVER (PARTITION BY source_pdf ORDER BY row_id)) AS nr FROM c)
SELECT concat_ws('_', 'OAT', upper(source_pdf), upper(slug), {_TWO.format('nr')}) AS id, source_pdf AS base, module_name AS label, nr::INT AS number, statement FROM n""")
def transversal_ids(spark, d):
    e = table(spark, d, "expected_learnings").where("module_name IS NOT NULL").withColumn("pid", F.concat_ws("|", "source_pdf", F.lpad(F.col("module_number").cast("string"), 9, "0"), "module_name"))
    parents = e.select("pid", F.col("source_pdf").alias("base"), F.col("module_name").alias("title")).distinct().withColumn("created", F.lit(None).cast("timestamp"))
    return dimensions.tree_ids(parents, e.select(F.col("row_id").alias("cid"), F.col("pid").alias("parent"), "number", "statement", F.col("row_id").alias("ord")), "OAT")


@query("cook_totals", "SELECT record_id, k.key, k.value ->> '$' AS value FROM nested_records, json_each(CASE WHEN json_valid(body) AND json_type(body::JSON, '$.metadata') = 'OBJECT' THEN body::JSON -> '$.metadata' ELSE '{}'::JSON END) k WHERE starts_with(k.key, 'total') AND json_type(k.value) NOT IN ('NULL', 'OBJECT', 'ARRAY')")
def cook_totals(spark, d):
    from telarium.operators import shred

    a = shred.shred(table(spark, d, "nested_records"))
    m = a.where("label = 'metadata' AND parent_id = 0 AND kind = 'object'").select(F.col("doc").alias("md"), F.col("node_id").alias("mid"))
    return a.where("label LIKE 'total%' AND scalar IS NOT NULL").join(m, (F.col("doc") == F.col("md")) & (F.col("parent_id") == F.col("mid"))).select("record_id", F.col("label").alias("key"), F.col("scalar").alias("value"))


@query("cook_indicator_search", f"""
SELECT row_id, nth - 1 AS position, left(x, 120) AS indicator FROM (SELECT row_id, unnest(indicators) AS x, generate_subscripts(indicators, 1) AS nth FROM table_rows) WHERE len(list_filter(regexp_extract_all({_FOLD.format('x')}, '[a-z0-9]+'), lambda t: t IN ('volcan', 'volcanes'))) > 0 ORDER BY row_id, nth LIMIT 20""")
def cook_indicator_search(spark, d):
    x = table(spark, d, "table_rows").select("row_id", F.posexplode("indicators").alias("position", "x"))
    hits = x.where(F.arrays_overlap(T.tokens(F.col("x")), F.array(F.lit("volcan"), F.lit("volcanes"))))
    return search.top(hits.select("row_id", F.col("position").cast("long").alias("position"), F.substring("x", 1, 120).alias("indicator")), [F.col("row_id"), F.col("position")], 20)


@query("cook_indicators_by_level", f"""
WITH i AS (SELECT category || '|' || number AS key, sum(n) AS n FROM (SELECT 'conocimiento' AS category, regexp_extract(code, '(\\d+)', 1)::INT AS number, coalesce(len(indicators), 0) AS n FROM table_rows WHERE regexp_matches(code, '\\d')) GROUP BY ALL)
SELECT o.level_id, count(DISTINCT o.oa_id) AS objectives, count(DISTINCT CASE WHEN i.n > 0 THEN o.oa_id END) AS with_indicators, coalesce(sum(i.n), 0)::BIGINT AS indicators FROM objectives o LEFT JOIN i ON o.category || '|' || o.oa_number = i.key GROUP BY o.level_id""")
def cook_indicators_by_level(spark, d):
    n = F.size(F.coalesce("indicators", F.array().cast("array<string>"))).cast("long")
    i = table(spark, d, "table_rows").where(F.col("code").rlike(r"\d")).groupBy(F.concat(F.lit("conocimiento|"), F.regexp_extract("code", r"(\d+)", 1).cast("int")).alias("key")).agg(F.sum(n).alias("n"))
    o = objectives(spark, d).select("level_id", "oa_id", F.concat("category", F.lit("|"), "oa_number").alias("key")).join(i, "key", "left")
    return o.groupBy("level_id").agg(F.countDistinct("oa_id").alias("objectives"), F.countDistinct(F.when(F.col("n") > 0, F.col("oa_id"))).alias("with_indicators"), F.coalesce(F.sum("n"), F.lit(0)).alias("indicators"))


@query("cook_transversal", "SELECT b.row_id, b.number, b.strand_eje, b.statement FROM bases_objectives b JOIN (SELECT DISTINCT level_id FROM offerings WHERE level_id = '1_medio' AND subject_id = 'matematica') f USING (level_id) WHERE b.formation_area = 'general'")
def cook_transversal(spark, d):
    f = table(spark, d, "offerings").where("level_id = '1_medio' AND subject_id = 'matematica'").select("level_id").distinct()
    return table(spark, d, "bases_objectives").where("formation_area = 'general'").join(f, "level_id").orderBy("number").select("row_id", "number", "strand_eje", "statement")


@query("cook_documents", "SELECT level_id, subject_id, doc_id, source_url FROM documents WHERE doc_type = 'guia' AND source_url IS NOT NULL")
def cook_documents(spark, d):
    return table(spark, d, "documents").where("doc_type = 'guia' AND source_url IS NOT NULL").orderBy("level_id", "subject_id").select("level_id", "subject_id", "doc_id", "source_url")


_ORDER = ["nivel_transicion", *[f"{i}_basico" for i in range(1, 9)], *[f"{i}_medio" for i in range(1, 5)]]


@query("level_order", "SELECT offering_key, row_number() OVER (ORDER BY coalesce(list_position([" + ", ".join(f"'{x}'" for x in _ORDER) + "], level_id), 999), level_id, subject_id) AS position FROM offerings")
def level_order(spark, d):
    return ordering.position_in_group(dimensions.by_rule(table(spark, d, "offerings"), [(f"level_id = '{x}'", f"{i:03}") for i, x in enumerate(_ORDER, 1)], "999", "rank").withColumn("all", F.lit(1)), ["all"], ["rank", "level_id", "subject_id"]).select("offering_key", F.col("position").cast("long").alias("position"))


@query("known_levels", "SELECT level_id, min(level_name) AS level_name, count(*) AS offerings, count(DISTINCT subject_id) AS subjects FROM offerings GROUP BY level_id")
def known_levels(spark, d):
    return table(spark, d, "offerings").groupBy("level_id").agg(F.min("level_name").alias("level_name"), F.count("*").alias("offerings"), F.countDistinct("subject_id").alias("subjects"))


@query("audit_prioritization", "SELECT offering_key, count(*) AS flagged, count(*) FILTER (WHERE curriculum_status IS NULL) AS without_metadata FROM objectives WHERE prioritized GROUP BY offering_key")
def audit_prioritization(spark, d):
    return audits.flags_without(objectives(spark, d), "prioritized", "curriculum_status", "offering_key")


@query("audit_schema_report", "WITH v AS (SELECT row_id, 'category' AS rule FROM objectives WHERE NOT coalesce(category IN ('conocimiento', 'actitud'), false) UNION ALL SELECT row_id, 'source' FROM objectives WHERE source IS NULL) SELECT rule, count(*) AS n, array_to_string(list_slice(list(row_id ORDER BY row_id), 1, 3), ',') AS examples FROM v GROUP BY rule")
def audit_schema_report(spark, d):
    v = audits.violations(objectives(spark, d), {"category": "category IN ('conocimiento', 'actitud')", "source": "source IS NOT NULL"})
    return audits.report(v, "rule", "row_id", 3).withColumn("examples", F.array_join("examples", ","))


@query("shared_programmes", "SELECT code, count(DISTINCT source_pdf) AS programmes, count(DISTINCT source_pdf) > 1 AS shared FROM table_rows WHERE code IS NOT NULL GROUP BY code")
def shared_programmes(spark, d):
    return table(spark, d, "table_rows").where("code IS NOT NULL").groupBy("code").agg(F.countDistinct("source_pdf").alias("programmes")).withColumn("shared", F.col("programmes") > 1)


@query("keyword_subset", f"SELECT row_id, list_has_all(regexp_extract_all({_FOLD.format('statement')}, '[a-z0-9]+'), list_transform(keywords, lambda k: {_FOLD.format('k')})) AS held FROM objectives WHERE keywords IS NOT NULL")
def keyword_subset(spark, d):
    held = F.size(F.array_except(F.transform("keywords", T.fold), T.tokens(F.col("statement")))) == 0
    return objectives(spark, d).where("keywords IS NOT NULL").select("row_id", held.alias("held"))


@query("export_text", f"SELECT row_id, '[' || coalesce(code, '') || '] ' || replace(coalesce(statement, ''), chr(10), chr(10) || '  ') || chr(10) || '  ' || concat_ws(' · ', subject_name, level_name) || coalesce(chr(10) || 'Indicadores de evaluación:' || array_to_string(list_transform(CASE WHEN len(keywords) > 0 THEN keywords END, lambda x: chr(10) || '  - ' || x), ''), '') AS block FROM {_JOINED}")
def export_text(spark, d):
    return _with_offering(spark, d).select("row_id", exports.plain_block(F.col("code"), F.concat_ws(" · ", "subject_name", "level_name"), F.col("statement"), F.col("keywords")).alias("block"))


_STR = "CASE WHEN {0} IS NULL THEN 'null' ELSE to_json({0})::VARCHAR END"


@query("export_json", "SELECT row_id, '{\"row_id\":' || row_id || ',\"code\":' || " + _STR.format("code") + " || ',\"strand_eje\":' || " + _STR.format("strand_eje") + " || ',\"prioritized\":' || coalesce(prioritized::VARCHAR, 'null') || '}' AS line FROM objectives")
def export_json(spark, d):
    return objectives(spark, d).select("row_id", exports.json_line(["row_id", "code", "strand_eje", "prioritized"]).alias("line"))


@query("export_ddl", "SELECT * FROM (VALUES ('indicators', 'CREATE TABLE indicators (row_id INTEGER, position INTEGER, statement TEXT)'), ('criteria', 'CREATE TABLE criteria (row_id INTEGER, position INTEGER, text TEXT)')) t(name, ddl)")
def export_ddl(spark, d):
    star = exports.star(table(spark, d, "table_rows"), table(spark, d, "expected_learnings"))
    return spark.createDataFrame([(n, exports.ddl(star[n], n)) for n in ("indicators", "criteria")], "name string, ddl string")


@query("provenance_filled", "SELECT row_id, coalesce(source, 'desconocido') AS source, coalesce(source_url, 'https://curriculo.example/' || offering_key) AS source_url FROM objectives")
def provenance_filled(spark, d):
    x = objectives(spark, d).select("row_id", "source", "source_url", "offering_key")
    return merging.fill_missing(x, {"source": F.lit("desconocido"), "source_url": F.concat(F.lit("https://curriculo.example/"), "offering_key")}).select("row_id", "source", "source_url")


@query("query_filtered", f"""
SELECT row_id, oa_id, code FROM objectives WHERE level_id = '1_medio' AND contains(subject_id, 'mat') AND category = 'conocimiento' AND contains({_FOLD.format("concat_ws(' ', statement, code, oa_id, array_to_string(keywords, ' '))")}, 'cuento') ORDER BY row_id LIMIT 20""")
def query_filtered(spark, d):
    return search.grep(objectives(spark, d), "Cuéntó", level="1_medio", subject="mat", category="conocimiento", limit=20).select("row_id", "oa_id", "code")


@query("statement_norms", f"SELECT md5(n) AS norm, count(*) AS n FROM (SELECT {_NORM.format('statement')} AS n FROM raw_objectives) GROUP BY n")
def statement_norms(spark, d):
    return table(spark, d, "raw_objectives").groupBy(T.normalize_statement(F.col("statement")).alias("t")).agg(F.count("*").alias("n")).select(F.md5("t").alias("norm"), "n")
