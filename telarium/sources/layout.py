"""Tables of objectives and indicators on captured page layouts, by geometry.

Input: blocks(doc, page, ord, x0, y0, text), one row for each text block. Everything is columns, windows within a page
and one as-of assignment; pages are independent, so the work spreads over all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telarium.functions import text as T

# Fixed values, in points: gap between the columns, drift of markers and of bullets and their continuations, rows.
COLUMN_GAP, MARKER_DRIFT, BULLET_DRIFT, CONTINUATION_DRIFT, ROW = 55.0, 40.0, 20.0, 45.0, 10.0
LEAST, SAMPLE = 12, 400
_PAGE = ["doc", "page"]
# Captions of columns, markers of objectives, bullets.
_OBJ, _IND = r"(?iu)objetivos\s+de\s+aprendizaje", r"(?iu)indicadores\s+de\s+evaluaci"
_STANDALONE = r"^\s*OA\s*([0-9]{1,2}|[A-Za-z])\s*\.?\s*$"
_PREFIXED = r"^\s*OA\s*([0-9]{1,2}|[A-Za-z])\s*[.:)]?\s+(?=\S)"
_BARE = r"^\s*([0-9]{1,2}|[A-Za-z])[.)]\s+(?=[A-ZÁÉÍÓÚÑ¿])"
_CAPTION = r"(?i)(?:se espera que.*capaces de|que han alcanzado este aprendizaje)"
_BULLET = r"^\s*(?:•|›|>>|‣|●|>(?=\s+[A-ZÁÉÍÓÚÑ])|ú(?=\s))"


def _marker(pattern: str) -> Column:
    return F.nullif(F.regexp_extract("text", pattern, 1), F.lit(""))


def table_rows(blocks: DataFrame) -> DataFrame:
    """(doc, page, code, y0, statement, indicators, joint): rows of pages that caption both columns.

    Where the page pairs each objective with its indicators, an indicator belongs to the last marker at most ROW below it;
    else all indicators belong to every marker (joint). Lines without a bullet continue the item above. Pages without
    markers or items give no row; null texts are skipped.
    """
    w = Window.partitionBy(*_PAGE)
    b = blocks.where(F.col("text").isNotNull()).withColumn("text", T.clean_extracted(F.col("text"))).where("text <> ''")
    b = b.withColumn("is_table", F.max(F.col("text").rlike(_OBJ).cast("int")).over(w) + F.max(F.col("text").rlike(_IND).cast("int")).over(w) == 2).where("is_table")
    b = b.withColumn("per_objective", F.max(F.col("text").rlike(_CAPTION).cast("int")).over(w) == 1)
    kinds = [_marker(_STANDALONE), _marker(_PREFIXED), F.when(F.col("per_objective"), _marker(_BARE))]
    level = F.when(kinds[0].isNotNull(), 1).when(kinds[1].isNotNull(), 2).when(kinds[2].isNotNull(), 3)
    b = b.withColumn("level", level).withColumn("code", F.coalesce(*kinds)).withColumn("best", F.min("level").over(w)).withColumn("is_marker", F.coalesce(F.col("level") == F.col("best"), F.lit(False)))
    xs = F.array_sort(F.collect_list(F.when(F.col("is_marker"), F.col("x0"))).over(w))
    b = b.withColumn("marker_x", F.when(F.size(xs) > 0, F.element_at(xs, (F.size(xs) / 2).cast("int") + 1))).where("marker_x IS NOT NULL")
    bullet = F.col("text").rlike(_BULLET)
    edge = F.min(F.when(bullet & (F.col("x0") - F.col("marker_x") > COLUMN_GAP), F.col("x0"))).over(w) - 2
    header = F.min(F.when(F.col("text").rlike(r"(?i)^indicadores\s+de\s+evaluaci") & (F.col("x0") - F.col("marker_x") > COLUMN_GAP), F.col("x0"))).over(w) - 17
    b = b.withColumn("edge", F.coalesce(edge, header)).where("edge IS NOT NULL")
    marks = b.where(F.col("is_marker") & (F.abs(F.col("x0") - F.col("marker_x")) < MARKER_DRIFT)).select(*_PAGE, "y0", "code", "per_objective", F.row_number().over(w.orderBy("y0", "ord")).alias("row"))
    off = F.col("x0") - F.col("edge")
    right = b.where((off >= 0) & (off <= F.when(bullet, BULLET_DRIFT).otherwise(CONTINUATION_DRIFT)) & ~T.is_decoration(F.col("text"))).withColumn("bullet", bullet)
    right = right.withColumn("any_bullet", F.max(F.col("bullet").cast("int")).over(w) == 1)
    items = F.when(F.col("bullet"), F.filter(T.split_bullets(F.col("text")), lambda x: ~T.is_furniture(x))).otherwise(F.array("text"))
    frag = right.select(*_PAGE, "y0", "ord", (F.col("bullet") | ~F.col("any_bullet")).alias("opens"), F.posexplode(items).alias("part", "text"))
    frag = frag.withColumn("row", F.lit(None).cast("int"))
    band = _as_of(frag.drop("row"), marks)
    run = Window.partitionBy(*_PAGE).orderBy("y0", "ord", "part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opened = band.withColumn("nr", F.sum(F.col("opens").cast("int")).over(run)).where("nr > 0")
    joined = opened.groupBy(*_PAGE, "nr").agg(F.min("row").alias("row"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("y0", "ord", "part", "text"))), lambda x: x["text"]), " ").alias("item"), F.min("y0").alias("y0")).where(F.length("item") >= LEAST)
    per = joined.groupBy(*_PAGE, F.col("row")).agg(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("nr", "item"))), lambda x: x["item"])).alias("indicators"))
    all_ = joined.groupBy(*_PAGE).agg(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("nr", "item"))), lambda x: x["item"])).alias("shared"))
    left = b.where((F.col("x0") < F.col("edge")) & (F.col("x0") >= F.col("marker_x") - MARKER_DRIFT) & ~T.is_decoration(F.col("text"))).select(*_PAGE, "y0", "ord", F.lit(0).alias("part"), F.lit(True).alias("opens"), "text")
    said = _as_of(left, marks).where("row IS NOT NULL").groupBy(*_PAGE, "row").agg(F.substring(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("y0", "ord", "text"))), lambda x: x["text"]), " "), 1, SAMPLE).alias("statement"))
    out = marks.join(per, [*_PAGE, "row"], "left").join(all_, _PAGE, "left").join(said, [*_PAGE, "row"], "left")
    found = F.when(F.col("per_objective"), F.col("indicators")).otherwise(F.col("shared"))
    return out.select(*_PAGE, "row", "code", "y0", F.coalesce("statement", F.lit("")).alias("statement"), found.alias("indicators"), (~F.col("per_objective")).alias("joint")).where(F.size("indicators") > 0)


def _as_of(frag: DataFrame, marks: DataFrame) -> DataFrame:
    """frag with the number of the last marker at most ROW below it."""
    a = marks.select(*_PAGE, (F.col("y0") - ROW).alias("k"), F.lit(0).alias("side"), F.col("row").alias("m"), *[F.lit(None).cast(frag.schema[c].dataType).alias(c) for c in ("y0", "ord", "part", "opens", "text")])
    c = frag.select(*_PAGE, F.col("y0").alias("k"), F.lit(1).alias("side"), F.lit(None).cast("int").alias("m"), "y0", "ord", "part", "opens", "text")
    w = Window.partitionBy(*_PAGE).orderBy("k", "side", "m", "ord").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return a.unionByName(c).withColumn("row", F.last("m", ignorenulls=True).over(w)).where("side = 1").drop("k", "side", "m")


def median_size(spans: DataFrame) -> DataFrame:
    """(doc, page, size): upper median of font sizes, weighted by characters; spans(doc, page, size, n_chars)."""
    w = Window.partitionBy(*_PAGE)
    x = spans.where("n_chars > 0").groupBy(*_PAGE, "size").agg(F.sum("n_chars").alias("n")).withColumn("before", F.sum("n").over(w.orderBy("size")) - F.col("n")).withColumn("total", F.sum("n").over(w))
    return x.where("before <= floor(total / 2) AND floor(total / 2) < before + n").select(*_PAGE, "size")


# ---- modules --------------------------------------------------------------------------------------------------------

# Headers of modules, criteria and learnings.
_HEADER = r"(?isu)M[oó]dulo\s+(\d+)\s*[·:.•\-]\s*(.{1,160}?)\s+(\d+)\s*Horas"
_GRADE = r"(?isu)Horas.{0,60}?(Tercero|Cuarto)\s+medio"
_CRITERION, _EXPECTED, _LONE = r"^(\d{1,2})\.(\d{1,2})\s+", r"^(\d{1,2})(?:[.)]\s+(?:\d{1,2}[.)]\s+)?(?=\D)|\s+(?=[A-ZÁÉÍÓÚÑ]))", r"^(\d{1,2})[.)]$"
MOST = 30


def module_events(blocks: DataFrame) -> DataFrame:
    """(doc, module, page, ord, kind, number, text): what each block of a module's pages says.

    kind is learning, criterion, generic or objective. The last module header and the last open learning carry over pages of
    a document; pages outside the section close the module. A lone number belongs to the cell right of it on the same line.
    """
    page = Window.partitionBy(*_PAGE)
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", F.coalesce("text", F.lit("")).alias("t"))).over(page)), lambda x: x["t"]), "\n")
    b = blocks.withColumn("whole", whole)
    b = b.withColumn("in_section", F.col("whole").rlike(r"(?isu)aprendizajes\s+esperados.{0,40}criterios\s+de\s+evaluaci"))
    head = F.struct(F.regexp_extract("whole", _HEADER, 1).cast("int").alias("number"), T.clean_extracted(F.regexp_extract("whole", _HEADER, 2)).alias("name"), F.regexp_extract("whole", _HEADER, 3).cast("int").alias("hours"), F.nullif(F.concat(F.initcap(F.regexp_extract("whole", _GRADE, 1)), F.lit(" medio")), F.lit(" medio")).alias("grade"))
    none = F.struct(F.lit(None).cast("int").alias("number"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("int").alias("hours"), F.lit(None).cast("string").alias("grade"))
    event = F.when(F.col("in_section") & F.col("whole").rlike(_HEADER), head).when(~F.col("in_section") & ~F.col("whole").rlike(_HEADER), none)
    flow = Window.partitionBy("doc").orderBy("page", "ord").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    b = b.withColumn("module", F.last(event, ignorenulls=True).over(flow)).where("in_section AND module.number IS NOT NULL")
    b = b.withColumn("text", T.clean_extracted(F.coalesce("text", F.lit("")))).where("text <> ''")
    o = page.orderBy("ord")
    nx = lambda c: F.lead(c).over(o)
    paired = F.col("text").rlike(_LONE) & (F.abs(nx("y0") - F.col("y0")) <= 6) & (nx("x0") > F.col("x0")) & (F.length(nx("text")) >= LEAST) & nx("text").rlike(r"^[A-ZÁÉÍÓÚÑ]") & ~nx("text").rlike(r"^OA\s*\w+\s")
    b = b.withColumn("paired", F.coalesce(paired, F.lit(False))).withColumn("number_before", F.when(F.lag("paired").over(o), F.regexp_extract(F.lag("text").over(o), _LONE, 1).cast("int"))).where("NOT text RLIKE '^[0-9]{1,2}[.)]$'")
    c1, e1 = F.regexp_extract("text", _CRITERION, 1).cast("int"), F.regexp_extract("text", _EXPECTED, 1).cast("int")
    body_c, body_e = F.regexp_replace("text", _CRITERION, ""), F.regexp_replace("text", _EXPECTED, "")
    kind = (
        F.when(F.col("number_before").isNotNull(), "learning").when(F.col("text").rlike(r"^OA\s*(\d{1,2}|[A-Za-z])\s"), "objective")
        .when(F.col("text").rlike(_CRITERION), F.when((c1 <= MOST) & (F.length(body_c) >= LEAST), "criterion"))
        .when(F.col("text").rlike(_EXPECTED), F.when((e1 <= MOST) & ~T.is_furniture(body_e), "learning")).when(F.col("text").rlike("^[A-Za-z]$"), "generic")
    )
    number = F.when(F.col("number_before").isNotNull(), F.col("number_before")).when(F.col("kind") == "criterion", c1).when(F.col("kind") == "learning", e1)
    said = F.when(F.col("kind") == "criterion", F.concat(c1, F.lit("."), F.regexp_extract("text", _CRITERION, 2), F.lit(" "), body_c)).when((F.col("kind") == "learning") & F.col("number_before").isNull(), body_e).when(F.col("kind") == "generic", F.upper("text")).otherwise(F.col("text"))
    b = b.withColumn("kind", kind).where("kind IS NOT NULL").withColumn("number", number).withColumn("said", said)
    held = Window.partitionBy("doc", "module").orderBy("page", "ord").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    b = b.withColumn("number", F.when(F.col("kind") == "generic", F.last("number", ignorenulls=True).over(held)).otherwise(F.col("number")))
    return b.select("doc", "module", "page", "ord", "kind", "number", F.col("said").alias("text"))


def learnings(events: DataFrame) -> DataFrame:
    """(doc, module, number, statement, criteria, generic): the first statement of each learning, its distinct criteria and letters in order."""
    pick = lambda k: F.array_distinct(F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == k, F.struct("page", "ord", "text")))), lambda x: x["text"]))
    x = events.where("number IS NOT NULL").groupBy("doc", "module", "number").agg(pick("learning").alias("s"), pick("criterion").alias("criteria"), pick("generic").alias("generic"))
    return x.where(F.size("s") + F.size("criteria") > 0).select("doc", "module", "number", F.try_element_at("s", F.lit(1)).alias("statement"), "criteria", "generic")


# ---- fall-back on the text of a page ----------------------------------------------------------------------------------

# Codes in running text, and headings that end the section.
_OA_IN_TEXT = r"\bOA\s*([0-9]{1,2}|[A-Za-z])\s*[.:)]\s"
_SECTION_END = r"(?m)^\s*(?:DURACI[ÓO]N|Duraci[óo]n|DESARROLLO|INICIO|CIERRE|RECURSOS|ORIENTACIONES|Observaciones al docente|Actividad|Recordemos|Se puede usar|Se sugiere delimitar)\b"


def rows_from_text(pages: DataFrame) -> DataFrame:
    """(doc, page, code, statement, indicators): joint rows of pages whose layout doesn't tell the columns apart.

    pages(doc, page, text). Codes stand between the captions of the columns, bulleted items behind the second one up to the next section;
    every code gets all distinct items. Pages without both captions, codes or items give no row.
    """
    obj, ind = r"(?isu)objetivos\s+de\s+aprendizaje", r"(?isu)indicadores\s+de\s+evaluaci\w*"
    after = F.split("text", obj, 2)
    halves = F.split(F.when(F.size(after) == 2, after[1]), ind, 2)
    x = pages.where(F.col("text").isNotNull()).select("doc", "page", halves.alias("h")).where("size(h) = 2")
    tail = F.split(F.col("h")[1], _SECTION_END, 2)[0]
    items = F.array_distinct(F.filter(F.transform(T.split_bullets(tail), T.clean_extracted), lambda i: ~T.is_furniture(i)))
    codes = F.regexp_extract_all(F.col("h")[0], F.lit(_OA_IN_TEXT), F.lit(1))
    said = F.slice(F.split(F.col("h")[0], _OA_IN_TEXT), 2, 1 << 20)
    pairs = F.explode(F.arrays_zip(codes.alias("code"), F.transform(said, T.clean_extracted).alias("statement")))
    return x.select("doc", "page", items.alias("indicators"), pairs.alias("p")).where("size(indicators) > 0 AND p.code IS NOT NULL").select("doc", "page", "p.code", "p.statement", "indicators")
