"""Registry of the core queries and of their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telarium.functions import text as T
from telarium.operators import aggregates, audits, dimensions, matching, merging, ordering, search, shred
from telarium.plans import exports
from telarium.sources import prose
from telarium.session import settle, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f

    return add


def _opened(x: str) -> str:
    return f"CASE WHEN json_type({x}) = 'VARCHAR' AND left(ltrim({x} ->> '$'), 1) IN ('[', '{{') AND json_valid({x} ->> '$') THEN CAST({x} ->> '$' AS JSON) ELSE {x} END"


def _children(parent: str, field: str, prefix: str) -> str:
    """Rows (record_id, parent_path, path, k, v) of the children in a field of the rows of parent; k is the place."""
    c = f"(SELECT record_id, path AS parent_path, {_opened(f'json_extract(v, {chr(39)}$.{field}{chr(39)})')} AS c, row_number() OVER () AS u FROM {parent} WHERE json_type(v) = 'OBJECT')"
    if not prefix:
        return f"SELECT record_id, parent_path, parent_path || '/' || e.key AS path, list_position(json_keys(x.c), e.key) - 1 AS k, {_opened('e.value')} AS v FROM {c} x, json_each(x.c) e WHERE json_type(x.c) = 'OBJECT' AND json_type(e.value) <> 'NULL'"
    numbered = "len(json_keys(x.c)) > 0 AND len(list_filter(json_keys(x.c), lambda k: NOT regexp_full_match(k, '\\d+'))) = 0"
    return f"""
SELECT record_id, parent_path, parent_path || '/{prefix}' || e.key AS path, e.key::INT AS k, {_opened('e.value')} AS v FROM {c} x, json_each(x.c) e WHERE json_type(x.c) = 'ARRAY' AND json_type(e.value) <> 'NULL'
UNION ALL SELECT record_id, parent_path, parent_path || '/{prefix}' || k AS path, k, v FROM (
  SELECT record_id, parent_path, {_opened('e.value')} AS v, row_number() OVER (PARTITION BY x.u ORDER BY CAST(e.key AS INT)) - 1 AS k FROM {c} x, json_each(x.c) e WHERE json_type(x.c) = 'OBJECT' AND {numbered}) WHERE json_type(v) <> 'NULL'
UNION ALL SELECT record_id, parent_path, parent_path || '/{prefix}0' AS path, 0 AS k, x.c AS v FROM {c} x WHERE json_type(x.c) NOT IN ('ARRAY', 'NULL') AND NOT (json_type(x.c) = 'OBJECT' AND ({numbered} OR len(json_keys(x.c)) = 0)) AND x.c <> '\"\"'"""


def _nested_tables() -> str:
    """One table n_ENTITY for each entity of shred.CHILDREN."""
    above: dict[str, list[tuple[str, str, str]]] = {e: [] for e in shred.ENTITIES}
    for parent, fields in shred.CHILDREN.items():
        for field, (child, prefix) in fields.items():
            above[child].append((parent, field, prefix))
    ctes = ["n_record AS (SELECT record_id, '' AS parent_path, 'root' AS path, 0 AS k, CAST(body AS JSON) AS v FROM nested_records WHERE json_valid(body))"]
    ctes += [f"n_{e} AS MATERIALIZED (" + " UNION ALL ".join(_children(f"n_{p}", f, x) for p, f, x in above[e]) + ")" for e in shred.ENTITIES[1:]]
    return "WITH " + ", ".join(ctes) + " "


def _nested_sql() -> str:
    """Paths of the nested records."""
    return _nested_tables() + " UNION ALL ".join(f"SELECT record_id, '{e}' AS node, path, parent_path FROM n_{e}" for e in shred.ENTITIES)


def _scalar(x: str) -> str:
    return f"CASE json_type({x}) WHEN 'VARCHAR' THEN {x} ->> '$' WHEN 'NULL' THEN NULL WHEN 'OBJECT' THEN NULL WHEN 'ARRAY' THEN NULL ELSE CAST({x} AS VARCHAR) END"


def _entity_sql(name: str) -> str:
    taken = {"record_id", "path", "parent_path", "ordinal", "text"}
    fields = ", ".join(f"{_scalar(f'json_extract(v, {chr(39)}$.{f}{chr(39)})')} AS {'f_' if f in taken else ''}{f}" for f in shred.FIELDS[name])
    return f"{_nested_tables()} SELECT record_id, path, parent_path, k AS ordinal, {_scalar('v')} AS text, {fields} FROM n_{name}"


@query("p3_found", _nested_sql())
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return shred.found_nodes(shred.entities(settle(shred.skeleton(shred.shred(table(spark, d, "nested_records"))))))


def _nested(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    adjacency = settle(shred.shred(table(spark, d, "nested_records")))
    return adjacency, shred.entities(adjacency)


@query("p3_totals", f"""{_nested_tables()}
SELECT *, total_oas <> objectives AS stale FROM (SELECT r.record_id, CASE WHEN regexp_full_match(any_value(r.t), '[+-]?\\d+') THEN any_value(r.t)::BIGINT END AS total_oas, count(o.record_id) AS objectives
FROM (SELECT record_id, {_scalar("json_extract(v, '$.metadata.total_oas')")} AS t FROM n_record) r LEFT JOIN n_objective o ON r.record_id = o.record_id GROUP BY r.record_id)""")
def p3_totals(spark: SparkSession, d: str) -> DataFrame:
    return shred.totals(*_nested(spark, d))


def _entity(name: str) -> Query:
    return lambda spark, d: shred.entity_table(*_nested(spark, d), name, shred.FIELDS[name])


for _e in shred.FIELDS:
    query(f"p3_{_e}s" if _e != "criterion" else "p3_criteria", _entity_sql(_e))(_entity(_e))


@query("p3_refused", "SELECT record_id, CASE WHEN body IS NULL THEN 'null' ELSE 'not_json' END AS reason FROM nested_records WHERE NOT coalesce(json_valid(body), false)")
def p3_refused(spark: SparkSession, d: str) -> DataFrame:
    return shred.refused(table(spark, d, "nested_records"))


# ---- text functions --------------------------------------------------------------------------------------------------

_FOLD = "lower(strip_accents(coalesce({0}, '')))"
_NORM = "trim(regexp_replace(" + _FOLD + ", '[^a-z0-9]+', ' ', 'g'))"
_SLUG = "regexp_replace(regexp_replace(lower(strip_accents({0})), '[^a-z0-9]+', '{1}', 'g'), '^{1}+|{1}+$', '', 'g')"
_LETTERS = "regexp_replace(lower({0}), '[^\\p{{L}}\\p{{N}}]+', '', 'g')"


def objectives(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "objectives")


@query("text_fold", f"SELECT row_id, {_FOLD.format('statement')} AS folded FROM objectives")
def text_fold(spark, d):
    return objectives(spark, d).select("row_id", T.fold(F.col("statement")).alias("folded"))


@query("text_slug", f"SELECT row_id, {_SLUG.format('strand_eje', '_')} AS strand, {_SLUG.format('code', '-')} AS code FROM objectives")
def text_slug(spark, d):
    return objectives(spark, d).select("row_id", T.slugify(F.col("strand_eje")).alias("strand"), T.slugify(F.col("code"), "-").alias("code"))


@query("text_normalized", f"SELECT row_id, {_NORM.format('statement')} AS norm FROM objectives")
def text_normalized(spark, d):
    return objectives(spark, d).select("row_id", T.normalize_statement(F.col("statement")).alias("norm"))


_STOP = ", ".join(f"'{w}'" for w in T.STOPWORDS)


@query("text_keywords", f"""
WITH w AS (SELECT row_id, list_filter(string_split_regex(regexp_replace(lower(statement), '[^\\p{{L}}\\p{{M}}\\p{{N}}_\\s-]', ' ', 'g'), '[\\s\\-]+'), lambda x: x <> '') AS ws FROM objectives),
x AS (SELECT row_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM w),
k AS (SELECT row_id, w, i, regexp_replace(strip_accents(w), '[\\x{{300}}-\\x{{36F}}]', '', 'g') AS key FROM x WHERE length(w) >= 4 AND regexp_replace(strip_accents(w), '[\\x{{300}}-\\x{{36F}}]', '', 'g') NOT IN ({_STOP}) AND (i = 1 OR NOT regexp_full_match(w, '\\d+'))),
f AS (SELECT row_id, key, arg_min(w, i) AS w, min(i) AS i FROM k GROUP BY row_id, key),
r AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY i) AS n FROM f)
SELECT o.row_id, coalesce(string_agg(r.w, ' ' ORDER BY r.n), '') AS keywords FROM objectives o LEFT JOIN r ON o.row_id = r.row_id AND r.n <= 12 GROUP BY o.row_id""")
def text_keywords(spark, d):
    return objectives(spark, d).select("row_id", F.array_join(T.keywords(F.col("statement")), " ").alias("keywords"))


_CODE_RE = "\\b(OAC|OAH|OAA|OAT|OAF|OA)\\b[\\s.\\-]*([A-Za-z0-9]*)"
_CODES = f"""
SELECT row_id, code, category, oa_number, nullif(regexp_extract(code, '{_CODE_RE}', 1), '') AS marker, nullif(regexp_extract(code, '{_CODE_RE}', 2), '') AS suffix FROM objectives"""
_PARSED = f"""
SELECT *, regexp_replace(suffix, '[^A-Za-z]', '', 'g') AS letters, CAST(nullif(list_extract(regexp_extract_all(suffix, '\\d+'), -1), '') AS INT) AS digits,
  CAST(nullif(regexp_extract(code, '(\\d+)\\s*\\.?\\s*$', 1), '') AS INT) AS last_number FROM ({_CODES})"""


@query("code_parts", f"""
SELECT row_id, marker, suffix, coalesce(digits, CASE WHEN length(letters) = 1 THEN ascii(lower(letters)) - 96 END, last_number, oa_number) AS number,
  category || '|' || coalesce(CAST(digits AS VARCHAR), CASE WHEN length(letters) = 1 THEN letters END) AS key FROM ({_PARSED})""")
def code_parts(spark, d):
    c = F.col("code")
    return objectives(spark, d).select("row_id", T.code_marker(c).alias("marker"), T.code_suffix(c).alias("suffix"), T.objective_number(c, F.col("oa_number")).alias("number"), T.objective_key(c, F.col("category")).alias("key"))


_ABBR_WORDS = "list_filter(string_split_regex(lower(strip_accents(subject_id)), '[^a-z0-9]+'), lambda x: x <> '')"


@query("subject_abbreviations", f"""
SELECT subject_id, upper(CASE WHEN len(ws) = 0 THEN 'XXX' WHEN len(ws) > 1 THEN left(array_to_string(list_transform(ws, lambda x: left(x, 1)), ''), 4) ELSE left(CASE WHEN length(sq) >= 3 THEN sq ELSE ws[1] END, 4) END) AS abbrev
FROM (SELECT subject_id, ws, left(ws[1], 1) || regexp_replace(substr(ws[1], 2), '[aeiou]', '', 'g') AS sq FROM (SELECT DISTINCT subject_id, {_ABBR_WORDS} AS ws FROM offerings))""")
def subject_abbreviations(spark, d):
    return table(spark, d, "offerings").select("subject_id").distinct().select("subject_id", T.derive_abbrev(F.col("subject_id")).alias("abbrev"))


@query("statement_flat", r"""
WITH l AS (SELECT row_id, list_filter(list_transform(string_split(coalesce(statement, ''), chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '') AS ls FROM objectives)
SELECT row_id, coalesce(CASE WHEN len(ls) <= 1 THEN ls[1] ELSE ls[1] || CASE WHEN regexp_matches(ls[1], '[:;]$') THEN ' ' ELSE ' - ' END ||
  array_to_string(list_transform(ls[2:], lambda x: regexp_replace(regexp_replace(x, '^-\s*', ''), '[.]+$', '')), '; ') || '.' END, '') AS flat, len(ls) - 1 AS components FROM l""")
def statement_flat(spark, d):
    return objectives(spark, d).select("row_id", T.flatten_statement(F.col("statement")).alias("flat"), T.component_count(F.col("statement")).cast("long").alias("components"))


@query("search_tokens", f"SELECT row_id, array_to_string(regexp_extract_all({_FOLD.format('statement')}, '[a-z0-9]+'), ' ') AS tokens FROM objectives")
def search_tokens(spark, d):
    return objectives(spark, d).select("row_id", F.array_join(T.tokens(F.col("statement")), " ").alias("tokens"))


# ---- audits and counts -----------------------------------------------------------------------------------------------

_RAW = "list_filter(string_split(coalesce(statement, ''), chr(10)), lambda x: trim(x, ' ') <> '')"
_FIND = f"""
SELECT row_id, unnest(CASE WHEN len(ls) = 0 THEN ['empty'] ELSE list_filter([
  CASE WHEN regexp_matches(ls[-1], '[:;]\\s*$') THEN 'ends_open' END, CASE WHEN contains(flat, chr(65533)) THEN 'replacement_character' END,
  CASE WHEN regexp_matches(flat, '[A-Za-zÁÉÍÓÚÑáéíóúñ]\\?[A-Za-zÁÉÍÓÚÑáéíóúñ]|\\?{{2,}}') THEN 'question_in_word' END, CASE WHEN regexp_matches(flat, '[a-záéíóúñ][.,;][A-ZÁÉÍÓÚÑ][a-záéíóúñ]') THEN 'joined_words' END,
  CASE WHEN len(list_filter(ls, lambda x: regexp_matches(x, '[a-záéíóúñ]-\\s+[a-záéíóúñ]') AND len(regexp_extract_all(x, '[A-Za-zÁÉÍÓÚÑáéíóúñ]-\\s')) > len(regexp_extract_all(x, '\\s-[A-Za-zÁÉÍÓÚÑáéíóúñ]')))) > 0 THEN 'broken_hyphen' END,
  CASE WHEN len(list_filter(string_split_regex(trim(flat, ' '), '\\s+'), lambda x: x <> '')) < 2 THEN 'few_words' END, CASE WHEN len(list_distinct(ls)) < len(ls) THEN 'repeated_line' END], lambda x: x IS NOT NULL) END) AS problem
FROM (SELECT row_id, ls, array_to_string(ls, ' ') AS flat FROM (SELECT row_id, {_RAW} AS ls FROM objectives))"""


@query("audit_text", _FIND)
def audit_text(spark, d):
    return audits.flagged(objectives(spark, d))


@query("audit_text_counts", f"SELECT problem, count(*) AS n FROM ({_FIND}) GROUP BY problem")
def audit_text_counts(spark, d):
    return audits.findings_by_problem(objectives(spark, d))


_KEYED = f"(SELECT row_id, oa_id, code, level_id, subject_id, concat_ws('/', level_id, subject_id) AS scope, {_NORM.format('statement')} AS norm FROM objectives)"


@query("audit_same_text", f"SELECT scope, norm, count(*) AS n, count(DISTINCT code) AS n_codes FROM {_KEYED} GROUP BY scope, norm HAVING count(*) > 1 AND count(DISTINCT code) > 1")
def audit_same_text(spark, d):
    return audits.same_text_different_codes(objectives(spark, d))


@query("audit_codes", f"""
SELECT code, n, n_texts, n_scopes, n_levels, CASE WHEN n_texts > 1 AND n_scopes = 1 THEN 'different_text' WHEN n_texts > 1 THEN 'scoped_to_subject' WHEN n_levels > 1 AND n_other = 0 THEN 'shared_expected' WHEN n_levels > 1 THEN 'shared_unexpected' ELSE 'same_record' END AS class
FROM (SELECT code, count(*) AS n, count(DISTINCT norm) AS n_texts, count(DISTINCT scope) AS n_scopes, count(DISTINCT level_id) AS n_levels, count(*) FILTER (WHERE coalesce(level_id, '') NOT IN ('3_medio', '4_medio')) AS n_other
  FROM {_KEYED} WHERE code <> '' GROUP BY code HAVING count(*) > 1)""")
def audit_codes(spark, d):
    return audits.code_classes(objectives(spark, d))


@query("audit_ids", f"SELECT oa_id, count(*) AS n, count(DISTINCT norm) > 1 AS conflicting FROM {_KEYED} WHERE oa_id IS NOT NULL GROUP BY oa_id HAVING count(*) > 1")
def audit_ids(spark, d):
    return audits.duplicate_ids(objectives(spark, d))


@query("audit_routes", "SELECT regexp_replace(source_url, '/[^/]*$', '') AS source_url, count(DISTINCT offering_key) AS n FROM documents WHERE source_url IS NOT NULL GROUP BY 1 HAVING count(DISTINCT offering_key) > 1")
def audit_routes(spark, d):
    return audits.routes_used_twice(table(spark, d, "documents").select("offering_key", F.regexp_replace("source_url", "/[^/]*$", "").alias("source_url")))


@query("audit_provenance", "SELECT problem, count(*) AS n FROM (SELECT CASE WHEN source IS NULL THEN 'no_source' WHEN source_url IS NULL THEN 'no_source_url' WHEN retrieved_at IS NULL THEN 'no_retrieved_at' END AS problem FROM objectives) WHERE problem IS NOT NULL GROUP BY problem")
def audit_provenance(spark, d):
    return audits.provenance(objectives(spark, d))


_STATUSES = ["vigente", "propuesta", "en_implementacion", "historico", "desconocido"]


@query("audit_status", "SELECT row_id, problem FROM (SELECT row_id, CASE WHEN curriculum_status IS NULL THEN 'missing' WHEN curriculum_status NOT IN (" + ", ".join(f"'{x}'" for x in _STATUSES) + ") THEN 'unknown' WHEN curriculum_status <> 'desconocido' AND source IS NULL THEN 'unsourced' END AS problem FROM objectives) WHERE problem IS NOT NULL")
def audit_status(spark, d):
    return audits.status_without_source(objectives(spark, d), _STATUSES)


@query("audit_regression", "SELECT k, 'added' AS change FROM (SELECT code AS k FROM objectives WHERE code IS NOT NULL EXCEPT SELECT code FROM raw_objectives) UNION ALL SELECT k, 'removed' FROM (SELECT code AS k FROM raw_objectives WHERE code IS NOT NULL EXCEPT SELECT code FROM objectives)")
def audit_regression(spark, d):
    return audits.regression(objectives(spark, d), table(spark, d, "raw_objectives"), "code")


_RULES = {"oa_id": "oa_id RLIKE '^CL_[A-Z0-9_]+$'", "code_slug": "code_slug RLIKE '^[a-z0-9-]+$'", "category": "category IN ('conocimiento', 'habilidad', 'actitud')", "number": "oa_number >= 1", "level": "level_id RLIKE '^[a-z0-9_]+$'"}


@query("audit_schema", "SELECT row_id, rule FROM (" + " UNION ALL ".join(f"SELECT row_id, '{k}' AS rule FROM objectives WHERE NOT coalesce({'regexp_matches(' + v.split(' RLIKE ')[0] + ', ' + v.split(' RLIKE ')[1] + ')' if ' RLIKE ' in v else v}, false)" for k, v in _RULES.items()) + ")")
def audit_schema(spark, d):
    return audits.violations(objectives(spark, d), _RULES)


@query("totals", "SELECT count(*) AS objectives, count(*) FILTER (WHERE category = 'conocimiento') AS conocimiento, count(*) FILTER (WHERE category = 'habilidad') AS habilidad, count(*) FILTER (WHERE category = 'actitud') AS actitud, count(DISTINCT offering_key) AS offerings, count(DISTINCT subject_id) AS subjects, count(DISTINCT level_id) AS levels, count(DISTINCT code) AS codes FROM objectives")
def totals(spark, d):
    return aggregates.totals(objectives(spark, d))


@query("level_category", "SELECT level_id, category, count(*) AS n FROM objectives GROUP BY level_id, category")
def level_category(spark, d):
    return aggregates.by_level_and_category(objectives(spark, d))


@query("indicator_coverage", "SELECT code, count(*) AS rows, count(*) FILTER (WHERE len(indicators) > 0) AS with_indicators, sum(coalesce(len(indicators), 0))::BIGINT AS indicators FROM table_rows GROUP BY code")
def indicator_coverage(spark, d):
    return aggregates.indicator_coverage(table(spark, d, "table_rows"))


@query("most_prioritized", "SELECT o.offering_key, o.prioritized, o.total, f.subject_name, f.level_name FROM (SELECT offering_key, count(*) FILTER (WHERE prioritized) AS prioritized, count(*) AS total FROM objectives GROUP BY offering_key HAVING count(*) FILTER (WHERE prioritized) >= 1) o JOIN offerings f USING (offering_key) ORDER BY o.prioritized DESC, o.offering_key LIMIT 15")
def most_prioritized(spark, d):
    return aggregates.most_prioritized(objectives(spark, d), table(spark, d, "offerings"), 1, 15)


@query("module_criteria", "SELECT source_pdf, module_number, max(hours) AS hours, count(DISTINCT number) AS learnings, sum(coalesce(len(criteria), 0))::BIGINT AS criteria FROM expected_learnings GROUP BY source_pdf, module_number")
def module_criteria(spark, d):
    return aggregates.modules_with_criteria(table(spark, d, "expected_learnings"))


# ---- order, bands, medians ---------------------------------------------------------------------------------------------


@query("position_in_group", "SELECT row_id, row_number() OVER (PARTITION BY offering_key, category, strand_eje ORDER BY row_id) AS position FROM objectives")
def position_in_group(spark, d):
    return ordering.position_in_group(objectives(spark, d), ["offering_key", "category", "strand_eje"], ["row_id"]).select("row_id", F.col("position").cast("long").alias("position"))


@query("unique_ids", "SELECT row_id, CASE WHEN n > 1 THEN oa_id || '__' || n ELSE oa_id END AS unique_id FROM (SELECT row_id, oa_id, row_number() OVER (PARTITION BY oa_id ORDER BY row_id) AS n FROM objectives WHERE oa_id IS NOT NULL)")
def unique_ids(spark, d):
    return ordering.unique_ids(objectives(spark, d).where("oa_id IS NOT NULL"), "oa_id", ["row_id"]).select("row_id", "unique_id")


@query("carry_forward", "SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS label FROM events")
def carry_forward(spark, d):
    return ordering.carry_forward(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], F.when(F.col("event_type") == "purchase", F.col("event_id"))).select("event_id", "label")


@query("band_assignment", """
SELECT i.event_id, max_by(m.event_id, (m.y, m.event_id)) AS mark FROM (SELECT *, epoch(ts) AS y FROM events WHERE event_type <> 'view') i
LEFT JOIN (SELECT *, epoch(ts) AS y FROM events WHERE event_type = 'view') m ON i.user_id = m.user_id AND m.y <= i.y + 10 GROUP BY i.event_id""")
def band_assignment(spark, d):
    e = table(spark, d, "events").withColumn("y", F.col("ts").cast("timestamp").cast("double"))
    marks = e.where("event_type = 'view'").select("user_id", "y", F.col("event_id").alias("mark"))
    return ordering.assign_bands(e.where("event_type <> 'view'").select("user_id", "y", "event_id"), marks, ["user_id"], "y", "mark", 10.0).select("event_id", "mark")


@query("regroup", """
SELECT user_id, nr, count(*) AS n, string_agg(event_type, ' ' ORDER BY ts, event_id) AS text FROM (SELECT *, sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nr FROM events) GROUP BY user_id, nr""")
def regroup(spark, d):
    return ordering.regroup(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "view", "event_type")


@query("upper_median", "SELECT l_returnflag, l_quantity AS median FROM (SELECT l_returnflag, l_quantity, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) AS r, count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem) WHERE r = floor(n / 2) + 1")
def upper_median(spark, d):
    return ordering.upper_median(table(spark, d, "lineitem"), ["l_returnflag"], "l_quantity")


# ---- matching by statements --------------------------------------------------------------------------------------------

_COMPACT = "regexp_replace(lower(strip_accents(replace(replace(coalesce({0}, ''), 'ﬁ', 'fi'), 'ﬂ', 'fl'))), '[^a-z0-9]', '', 'g')"
_GRAMS = "list_distinct(list_transform(range(1, length(t) - 3), lambda i: substr(t, i, 5)))"
_SCORES = f"""
a AS (SELECT row_id, g, {_GRAMS} AS grams FROM (SELECT row_id, {_LETTERS.format('code')} AS g, {_COMPACT.format("regexp_replace(statement, '^\\s*OA\\s*[0-9A-Za-z]{{1,2}}[.)]?\\s*', '')")} AS t FROM raw_objectives) WHERE length(t) >= 25),
b AS (SELECT row_id, g, {_GRAMS} AS grams FROM (SELECT row_id, {_LETTERS.format('code')} AS g, {_COMPACT.format('statement')} AS t FROM objectives) WHERE length(t) >= 25),
s AS (SELECT "row", objective, score FROM (SELECT a.row_id AS "row", b.row_id AS objective, len(list_intersect(a.grams, b.grams)) / least(len(a.grams), len(b.grams)) AS score FROM a JOIN b ON a.g = b.g) WHERE score >= 0.45)"""


def _matched(spark, d):
    c = copies_key(F.col("code"))
    pick = lambda x, k: x.select(F.col("row_id").alias(k), c.alias("g"), "statement", "category")
    return pick(table(spark, d, "raw_objectives"), "rid"), pick(objectives(spark, d), "oid")


def _scored(spark, d, near=None):
    a, b = _matched(spark, d)
    return matching.scores(a, b, "rid", "oid", "g", least=matching.CANDIDATE, near=near)


def copies_key(c):
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", "")


@query("statement_scores", f'WITH {_SCORES} SELECT "row", objective, score FROM s')
def statement_scores(spark, d):
    return _scored(spark, d)


_DECIDED = """
r AS (SELECT s.*, row_number() OVER w AS rk, max(score) OVER (PARTITION BY "row") AS best, lead(score, 1, 0.0) OVER w AS nxt FROM s WINDOW w AS (PARTITION BY "row" ORDER BY score DESC, objective)),
g AS (SELECT r."row", max(best) AS best, max(CASE WHEN rk = 1 THEN nxt END) AS runner, max(CASE WHEN rk = 1 THEN objective END) AS first, count(*) FILTER (WHERE best - score < 0.1 AND x.category = o.category) AS n, max(CASE WHEN best - score < 0.1 AND x.category = o.category THEN objective END) AS coded
  FROM r JOIN raw_objectives x ON x.row_id = r."row" JOIN objectives o ON o.row_id = r.objective GROUP BY r."row"),
o AS (SELECT *, CASE WHEN best < 0.55 THEN 'rejected' WHEN best - runner < 0.1 AND n <> 1 THEN 'ambiguous' ELSE 'attached' END AS outcome FROM g)"""


def _decided(spark, d):
    a, b = _matched(spark, d)
    return matching.decide_standings(matching.standings(a, b, "rid", "oid", "g", "category"))


@query("attach_best", f'WITH {_SCORES}, {_DECIDED} SELECT "row", outcome, CASE WHEN outcome = \'ambiguous\' THEN NULL WHEN best - runner < 0.1 AND best >= 0.55 THEN coded ELSE first END AS objective, best AS score FROM o')
def attach_best(spark, d):
    return _decided(spark, d)


@query("attach_outcomes", f"WITH {_SCORES}, {_DECIDED} SELECT outcome, count(*) AS n FROM o GROUP BY outcome")
def attach_outcomes(spark, d):
    return _decided(spark, d).groupBy("outcome").agg(F.count("*").alias("n"))


@query("link_first", f'WITH {_SCORES} SELECT "row", objective, score FROM (SELECT *, row_number() OVER (PARTITION BY "row" ORDER BY score DESC, objective) AS k FROM s WHERE score >= 0.55) WHERE k = 1')
def link_first(spark, d):
    return matching.first_match(_scored(spark, d, 0.0))


# ---- merges and comparisons --------------------------------------------------------------------------------------------


@query("merge_best", "SELECT oa_id, row_id, source FROM (SELECT *, row_number() OVER (PARTITION BY oa_id ORDER BY CASE source WHEN 'portal_html' THEN 0 WHEN 'bases_pdf' THEN 1 ELSE 2 END, row_id) AS k FROM objectives WHERE oa_id IS NOT NULL) WHERE k = 1")
def merge_best(spark, d):
    rank = F.when(F.col("source") == "portal_html", 0).when(F.col("source") == "bases_pdf", 1).otherwise(2)
    return merging.best_by_rank(objectives(spark, d).where("oa_id IS NOT NULL"), ["oa_id"], [rank, F.col("row_id")]).select("oa_id", "row_id", "source")


@query("insert_preference", """
WITH x AS (SELECT *, statement IS NOT NULL AS has FROM objectives WHERE oa_id IS NOT NULL), y AS (SELECT *, row_number() OVER w AS n, first_value(has) OVER w AS f, max(has::INT) OVER (PARTITION BY oa_id) = 1 AS a, row_number() OVER (PARTITION BY oa_id, has ORDER BY row_id) AS k FROM x WINDOW w AS (PARTITION BY oa_id ORDER BY row_id)),
z AS (SELECT *, CASE WHEN n = 1 THEN CASE WHEN has OR NOT a THEN 'new' ELSE 'folded' END WHEN has THEN CASE WHEN k = 1 AND NOT f THEN 'kept' ELSE 'qualified' END ELSE CASE WHEN a THEN 'folded' ELSE 'qualified' END END AS outcome FROM y)
SELECT row_id, outcome, CASE WHEN outcome = 'qualified' THEN concat_ws('__', oa_id, source) ELSE oa_id END AS stored_as FROM z""")
def insert_preference(spark, d):
    return merging.insert_with_preference(objectives(spark, d).where("oa_id IS NOT NULL"), ["oa_id"], F.col("statement").isNotNull(), ["row_id"], "source").select("row_id", "outcome", "stored_as")


_HELD = "SELECT offering_key, count(*) FILTER (WHERE statement IS NOT NULL) AS n FROM objectives WHERE offering_key IS NOT NULL GROUP BY offering_key"
_COVER = f"SELECT coalesce(e.offering_key, h.offering_key) AS offering_key, coalesce(h.n, 0) AS n, CASE WHEN e.offering_key IS NULL THEN 'unexpected' WHEN h.n IS NULL THEN 'missing' WHEN h.n > 0 THEN 'ingested' ELSE 'empty' END AS status FROM (SELECT DISTINCT offering_key FROM offerings) e FULL OUTER JOIN ({_HELD}) h ON e.offering_key = h.offering_key"


@query("coverage", _COVER)
def coverage(spark, d):
    held = objectives(spark, d).where("offering_key IS NOT NULL").groupBy("offering_key").agg(F.count("statement").alias("n"))
    return merging.coverage(table(spark, d, "offerings"), held, ["offering_key"])


@query("coverage_summary", f"SELECT status, count(*) AS offerings FROM ({_COVER}) GROUP BY status")
def coverage_summary(spark, d):
    return coverage(spark, d).groupBy("status").agg(F.count("*").alias("offerings"))


_FIRST = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY row_id) AS k FROM {0} WHERE code IS NOT NULL) WHERE k = 1)"


@query("verify_fields", f"""
WITH s AS {_FIRST.format('objectives')}, l AS {_FIRST.format('raw_objectives')}, j AS (SELECT coalesce(s.code, l.code) AS key, s.code AS sc, l.code AS lc, coalesce(s.category, '') AS c1, coalesce(l.category, '') AS c2, coalesce(s.statement, '') AS t1, coalesce(l.statement, '') AS t2, coalesce(s.strand_kind, '') AS k1, coalesce(l.strand_kind, '') AS k2 FROM s FULL OUTER JOIN l ON s.code = l.code)
SELECT key, '*' AS field, CASE WHEN sc IS NULL THEN 'missing' ELSE 'extra' END AS kind FROM j WHERE sc IS NULL OR lc IS NULL
UNION ALL SELECT key, 'category', 'differs' FROM j WHERE sc IS NOT NULL AND lc IS NOT NULL AND c1 <> c2 UNION ALL SELECT key, 'statement', 'differs' FROM j WHERE sc IS NOT NULL AND lc IS NOT NULL AND t1 <> t2
UNION ALL SELECT key, 'strand_kind', 'differs' FROM j WHERE sc IS NOT NULL AND lc IS NOT NULL AND k1 <> k2""")
def verify_fields(spark, d):
    first = lambda n: search.first_by(table(spark, d, n).where("code IS NOT NULL"), "code", ["row_id"])
    return merging.differences(first("objectives"), first("raw_objectives"), "code", ["category", "statement", "strand_kind"])


@query("insert_absent", "SELECT row_id, code, 'o' AS origin FROM objectives UNION ALL SELECT r.row_id, r.code, 'r' FROM raw_objectives r WHERE NOT EXISTS (SELECT 1 FROM objectives o WHERE o.code = r.code)")
def insert_absent(spark, d):
    pick = lambda n, o: table(spark, d, n).select("row_id", "code", F.lit(o).alias("origin"))
    return merging.insert_absent(pick("objectives", "o"), pick("raw_objectives", "r"), ["code"])


@query("corrections", """
WITH c AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_brand ELSE 'Brand#0' END AS o, CASE WHEN p_partkey % 5 = 0 THEN p_brand ELSE 'Brand#new' END AS c FROM part WHERE p_partkey % 2 = 0),
j AS (SELECT p.p_partkey, p.p_brand, CASE WHEN c.c IS NULL THEN NULL WHEN p.p_brand = c.c THEN 'already applied' WHEN p.p_brand = c.o THEN 'applied' ELSE 'skipped' END AS correction_status, c.c FROM part p LEFT JOIN c USING (p_partkey))
SELECT p_partkey, CASE WHEN correction_status = 'applied' THEN c ELSE p_brand END AS p_brand, correction_status FROM j""")
def corrections(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_brand")
    k = F.col("p_partkey")
    c = p.where(k % 2 == 0).select("p_partkey", F.when(k % 3 == 0, F.col("p_brand")).otherwise("Brand#0").alias("original_value"), F.when(k % 5 == 0, F.col("p_brand")).otherwise("Brand#new").alias("corrected_value"))
    return merging.compare_and_set(p, c, ["p_partkey"], "p_brand")


# ---- search ------------------------------------------------------------------------------------------------------------

_POST = f"SELECT DISTINCT row_id, unnest(regexp_extract_all({_FOLD.format('statement')} || ' ' || {_FOLD.format('code')} || ' ' || {_FOLD.format('strand_eje')}, '[a-z0-9]+')) AS token FROM objectives"


def _postings(spark, d):
    return search.postings(objectives(spark, d), "row_id", [F.col("statement"), F.col("code"), F.col("strand_eje")])


@query("postings", f"SELECT token, count(*) AS rows FROM ({_POST}) GROUP BY token")
def postings(spark, d):
    return _postings(spark, d).groupBy("token").agg(F.count("*").alias("rows"))


@query("search_boolean", f"SELECT row_id FROM ({_POST}) GROUP BY row_id HAVING bool_or(starts_with(token, 'control')) AND bool_or(starts_with(token, 'cuent'))")
def search_boolean(spark, d):
    return search.matching(_postings(spark, d), "row_id", "Contról cuent")


_SCORE = " + ".join(
    f"CASE WHEN contains(c, '{t}') THEN 40 ELSE 0 END + CASE WHEN starts_with(s, '{t}') THEN 12 ELSE 0 END + CASE WHEN contains(s, '{t}') THEN 10 ELSE 0 END + CASE WHEN contains(k, '{t}') THEN 5 ELSE 0 END + CASE WHEN contains(e, '{t}') THEN 3 ELSE 0 END" for t in ("reparar", "cuento"))


@query("search_ranked", f"""
SELECT row_id, coalesce(prioritized, false)::INT + {_SCORE} AS score FROM (SELECT row_id, prioritized, {_FOLD.format('code')} AS c, {_FOLD.format('statement')} AS s, {_FOLD.format("array_to_string(keywords, ' ')")} AS k, {_FOLD.format('strand_eje')} AS e FROM objectives)
WHERE row_id IN (SELECT row_id FROM ({_POST}) GROUP BY row_id HAVING bool_or(starts_with(token, 'reparar')) AND bool_or(starts_with(token, 'cuento'))) ORDER BY score DESC, row_id LIMIT 20""")
def search_ranked(spark, d):
    hits = search.matching(_postings(spark, d), "row_id", "reparar cuento")
    s = search.score("reparar cuento", F.col("code"), F.col("statement"), F.array_join("keywords", " "), F.col("strand_eje"), F.lit(""), F.col("prioritized"))
    return search.top(objectives(spark, d).join(hits, "row_id", "left_semi").select("row_id", s.alias("score")), [F.desc("score"), F.col("row_id")], 20)


_HAY = f"{_FOLD.format(chr(39).join(['concat_ws(', ' ', ', statement, code, oa_id)']))}"


@query("search_substring", f"SELECT row_id FROM objectives WHERE level_id = '1_medio' AND contains({_HAY}, 'cuento') ORDER BY row_id LIMIT 20")
def search_substring(spark, d):
    x = search.substring(objectives(spark, d).where("level_id = '1_medio'"), "Cuento", [F.col("statement"), F.col("code"), F.col("oa_id")])
    return search.top(x.select("row_id"), [F.col("row_id")], 20)


@query("search_bm25", f"""
WITH t AS (SELECT row_id, regexp_extract_all({_FOLD.format('statement')}, '[a-z0-9]+') AS ts FROM objectives), n AS (SELECT count(*) AS N, avg(len(ts)) AS al, count(*) FILTER (WHERE list_contains(ts, 'volcan')) AS d0, count(*) FILTER (WHERE list_contains(ts, 'glaciar')) AS d1 FROM t),
x AS (SELECT row_id, len(ts) AS l, len(list_filter(ts, lambda y: y = 'volcan')) AS f0, len(list_filter(ts, lambda y: y = 'glaciar')) AS f1 FROM t)
SELECT row_id, round(ln(1 + (N - d0 + 0.5) / (d0 + 0.5)) * f0 * 2.2 / (f0 + 1.2 * (0.25 + 0.75 * l / al)) + ln(1 + (N - d1 + 0.5) / (d1 + 0.5)) * f1 * 2.2 / (f1 + 1.2 * (0.25 + 0.75 * l / al)), 6) AS score FROM x, n WHERE f0 + f1 > 0""")
def search_bm25(spark, d):
    return search.bm25(objectives(spark, d), "row_id", F.col("statement"), "volcán glaciar").select("row_id", F.round("score", 6).alias("score"))


@query("facets", " UNION ALL ".join(f"SELECT '{c}' AS facet, {c} AS value, count(*) AS n FROM objectives WHERE {c} IS NOT NULL GROUP BY {c}" for c in ("level_id", "category", "strand_eje", "curriculum_status", "source")))
def facets(spark, d):
    return search.facets(objectives(spark, d), ["level_id", "category", "strand_eje", "curriculum_status", "source"])


@query("progression", """
WITH a AS (SELECT * FROM bases_objectives WHERE row_id % 100 = 0)
SELECT a.row_id, b.row_id AS other FROM a JOIN bases_objectives b ON a.code = b.code AND a.row_id <> b.row_id
UNION SELECT a.row_id, b.row_id FROM a JOIN bases_objectives b ON a.strand_eje = b.strand_eje AND a.subject_slug = b.subject_slug AND a.number = b.number AND a.level_id <> b.level_id""")
def progression(spark, d):
    x = table(spark, d, "bases_objectives").select("row_id", "code", "strand_eje", F.col("subject_slug").alias("subject_id"), F.col("number").alias("oa_number"), "level_id")
    return search.progression(x, asked=x.where("row_id % 100 = 0"))


@query("search_explained", f"SELECT row_id, concat_ws(',', CASE WHEN contains({_FOLD.format('code')}, 'lec') THEN 'code' END, CASE WHEN contains({_FOLD.format('statement')}, 'lec') THEN 'statement' END, CASE WHEN contains({_FOLD.format('strand_eje')}, 'lec') THEN 'strand' END) AS fields FROM objectives")
def search_explained(spark, d):
    return objectives(spark, d).select("row_id", F.array_join(search.explain("lec", code=F.col("code"), statement=F.col("statement"), strand=F.col("strand_eje")), ",").alias("fields"))


@query("code_order", "SELECT row_id, array_to_string(list_transform(regexp_extract_all(lower(code), '\\d+|\\D+'), lambda p: CASE WHEN regexp_full_match(p, '\\d+') THEN lpad(p, 10, '0') ELSE p END), '') AS sort_key FROM objectives")
def code_order(spark, d):
    return objectives(spark, d).select("row_id", search.code_order(F.col("code")).alias("sort_key"))


# ---- exports -----------------------------------------------------------------------------------------------------------

_JOINED = "(SELECT o.*, f.subject_name, f.level_name, f.track FROM objectives o LEFT JOIN offerings f USING (offering_key))"


def _with_offering(spark, d):
    return objectives(spark, d).join(table(spark, d, "offerings").select("offering_key", "subject_name", "level_name", "track"), "offering_key", "left")


_CELL = "'\"' || replace(coalesce(regexp_replace({0}::VARCHAR, chr(10), ' ', 'g'), ''), '\"', '\"\"') || '\"'"


@query("export_csv", "SELECT row_id, concat_ws(',', " + ", ".join(_CELL.format(c) for c in ("code", "level_name", "subject_name", "strand_eje", "category", "curriculum_status", "statement")) + f") AS line FROM {_JOINED}")
def export_csv(spark, d):
    return _with_offering(spark, d).select("row_id", exports.csv_line([F.col(c) for c in ("code", "level_name", "subject_name", "strand_eje", "category", "curriculum_status", "statement")]).alias("line"))


@query("export_prompt", f"SELECT row_id, '[' || coalesce(code, '') || '] ' || concat_ws(' · ', subject_name, level_name, track) || chr(10) || replace(regexp_replace(coalesce(statement, ''), '\\n\\s*-\\s*', '; ', 'g'), chr(10), ' ') AS block FROM {_JOINED}")
def export_prompt(spark, d):
    return _with_offering(spark, d).select("row_id", exports.prompt_block(F.col("code"), F.col("subject_name"), F.col("level_name"), F.col("track"), F.col("statement"), F.array().cast("array<string>")).alias("block"))


_MD = "array_to_string(list_transform(ls, lambda x, i: CASE WHEN i = 1 THEN x ELSE '- ' || regexp_replace(x, '^-\\s*', '') END), chr(10))"


@query("export_markdown", f"""
SELECT offering_key, count(*) AS n, sum(length(t))::BIGINT AS chars, md5(string_agg(t, chr(10) || '---' || chr(10) || chr(10) ORDER BY row_id)) AS digest FROM (SELECT offering_key, row_id, '### ' || coalesce(code, '') || ' — ' || concat_ws(', ', subject_name, level_name) || chr(10) ||
  CASE WHEN strand_eje IS NOT NULL THEN '*' || coalesce(strand_kind, 'eje') || ': ' || strand_eje || '*' || chr(10) ELSE '' END || chr(10) || {_MD} || chr(10) AS t
  FROM (SELECT *, list_filter(list_transform(string_split(coalesce(statement, ''), chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '') AS ls FROM {_JOINED})) GROUP BY offering_key""")
def export_markdown(spark, d):
    x = _with_offering(spark, d).select("offering_key", "row_id", exports.markdown_block(F.col("code"), F.col("subject_name"), F.col("level_name"), F.col("strand_kind"), F.col("strand_eje"), F.col("statement")).alias("t"))
    doc = exports.joined(x, ["offering_key"], ["row_id"], F.col("t"), "\n---\n\n")
    return doc.join(x.groupBy(F.col("offering_key").alias("k")).agg(F.count("*").alias("n"), F.sum(F.length("t")).cast("long").alias("chars")), F.col("offering_key").eqNullSafe(F.col("k"))).select("offering_key", "n", "chars", F.md5("document").alias("digest"))


@query("export_slim", "SELECT level_id, subject_id, count(*) AS objectives, min(row_id) AS first_row FROM objectives WHERE offering_key IS NOT NULL GROUP BY level_id, subject_id")
def export_slim(spark, d):
    return exports.slim(objectives(spark, d)).select("level_id", "subject_id", F.size("learning_objectives").cast("long").alias("objectives"), F.col("learning_objectives")[0]["row_id"].alias("first_row"))


@query("export_level_index", "SELECT level_id, level_id || '.json' AS file, array_to_string(list_sort(list(DISTINCT subject_id) FILTER (WHERE subject_id IS NOT NULL)), ',') AS subjects, count(*) AS total_oas FROM objectives WHERE level_id IS NOT NULL GROUP BY level_id")
def export_level_index(spark, d):
    return exports.level_index(objectives(spark, d)).withColumn("subjects", F.array_join("subjects", ","))


@query("star_indicators", "SELECT row_id, position, statement FROM (SELECT row_id, unnest(indicators) AS statement, generate_subscripts(indicators, 1) - 1 AS position FROM table_rows)")
def star_indicators(spark, d):
    return exports.star(table(spark, d, "table_rows"), table(spark, d, "expected_learnings"))["indicators"].select("row_id", F.col("position").cast("long").alias("position"), "statement")


@query("star_criteria", "SELECT row_id, position, text FROM (SELECT row_id, unnest(criteria) AS text, generate_subscripts(criteria, 1) - 1 AS position FROM expected_learnings)")
def star_criteria(spark, d):
    return exports.star(table(spark, d, "table_rows"), table(spark, d, "expected_learnings"))["criteria"].select("row_id", F.col("position").cast("long").alias("position"), "text")


# ---- cookbook ----------------------------------------------------------------------------------------------------------


@query("cook_subject", "SELECT code, strand_eje, statement FROM objectives WHERE level_id = '1_medio' AND subject_id = 'matematica'")
def cook_subject(spark, d):
    return objectives(spark, d).where("level_id = '1_medio' AND subject_id = 'matematica'").orderBy("category", "strand_eje", "oa_number").select("code", "strand_eje", "statement")


@query("cook_code", "SELECT oa_id, level_id, subject_id, statement FROM objectives WHERE code = 'MA1M OA 01'")
def cook_code(spark, d):
    return objectives(spark, d).where("code = 'MA1M OA 01'").select("oa_id", "level_id", "subject_id", "statement")


@query("cook_skills", "SELECT category, code, strand_eje, statement FROM objectives WHERE level_id = '1_medio' AND subject_id = 'matematica' AND category IN ('habilidad', 'actitud')")
def cook_skills(spark, d):
    return objectives(spark, d).where(F.col("category").isin("habilidad", "actitud") & (F.col("level_id") == "1_medio") & (F.col("subject_id") == "matematica")).select("category", "code", "strand_eje", "statement")


@query("cook_indicators_of_code", "SELECT t.row_id, t.position, t.statement FROM (SELECT row_id, code, unnest(indicators) AS statement, generate_subscripts(indicators, 1) - 1 AS position FROM table_rows) t WHERE t.code = 'OA 1'")
def cook_indicators_of_code(spark, d):
    return table(spark, d, "table_rows").where("code = 'OA 1'").select("row_id", F.posexplode("indicators").alias("position", "statement")).select("row_id", F.col("position").cast("long").alias("position"), "statement")


@query("cook_coverage_by_level", "SELECT f.level_id, count(DISTINCT f.offering_key) AS offerings, count(DISTINCT o.offering_key) AS with_objectives, count(o.row_id) AS objectives FROM offerings f LEFT JOIN objectives o USING (offering_key) GROUP BY f.level_id")
def cook_coverage_by_level(spark, d):
    f, o = table(spark, d, "offerings").select("offering_key", "level_id"), objectives(spark, d).groupBy("offering_key").agg(F.count("*").alias("n"))
    return f.join(o, "offering_key", "left").groupBy("level_id").agg(F.countDistinct("offering_key").alias("offerings"), F.count("n").alias("with_objectives"), F.coalesce(F.sum("n"), F.lit(0)).alias("objectives"))


@query("cook_joint_rows", "SELECT DISTINCT source_pdf, code FROM table_rows WHERE joint")
def cook_joint_rows(spark, d):
    return table(spark, d, "table_rows").where("joint").select("source_pdf", "code").distinct()


@query("cook_criteria_of_learning", "SELECT e.row_id, e.number, unnest(e.criteria) AS criterion FROM expected_learnings e WHERE module_number = 1")
def cook_criteria_of_learning(spark, d):
    return table(spark, d, "expected_learnings").where("module_number = 1").select("row_id", "number", F.explode("criteria").alias("criterion"))


@query("cook_sources", "SELECT source, doc_type, count(*) AS n, min(n_chars) AS shortest, max(n_chars) AS longest FROM documents GROUP BY source, doc_type")
def cook_sources(spark, d):
    return table(spark, d, "documents").groupBy("source", "doc_type").agg(F.count("*").alias("n"), F.min("n_chars").alias("shortest"), F.max("n_chars").alias("longest"))


# ---- readers -----------------------------------------------------------------------------------------------------------


_LINES = r"""
l AS (SELECT page_id AS page, pos, regexp_replace(line, '[\r\s]+$', '') AS line FROM (SELECT page_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM bases_pages WHERE text IS NOT NULL))"""
_PROSE = rf"""
WITH {_LINES},
n AS (SELECT *, count(number) OVER (PARTITION BY page ORDER BY pos) AS nr FROM (SELECT *, nullif(regexp_extract(line, '^OA\s*(\d+)\.\s*', 1), '')::INT AS number FROM l WHERE line <> '')),
b AS (SELECT *, trim(regexp_replace(regexp_replace(line, '^OA\s*(\d+)\.\s*', ''), '^(?:[-•›‣●*]|\ty)\s*', ''), ' ') AS body, sum((number IS NOT NULL OR regexp_matches(line, '^(?:[-•›‣●*]|\ty)\s*'))::INT) OVER (PARTITION BY page, nr ORDER BY pos) AS part FROM n WHERE nr > 0),
p AS (SELECT page, nr, part, max(number) AS number, string_agg(body, ' ' ORDER BY pos) AS t FROM b GROUP BY ALL),
w AS (SELECT page, nr, max(number) AS number, string_agg(CASE WHEN part = 1 THEN t ELSE '- ' || t END, chr(10) ORDER BY part) AS t FROM p GROUP BY ALL),
o AS (SELECT *, coalesce(label <> '' AND len(string_split_regex(label, '\s+')) <= 6 AND NOT ends_with(label, '.'), false) AS is_strand FROM (SELECT *, regexp_extract(t, '\(([^()]{{2,80}})\)\s*$', 1) AS label FROM w)),
f AS (SELECT page, number, trim(CASE WHEN is_strand THEN regexp_replace(t, '\s*\([^()]{{2,80}}\)\s*$', '') ELSE t END, ' ') AS statement, CASE WHEN is_strand THEN trim(label, ' ') END AS strand FROM o)"""


@query("prose_objectives", f"{_PROSE} SELECT * FROM f")
def prose_objectives(spark, d):
    return prose.objectives(table(spark, d, "bases_pages"))


@query("prose_ideas", rf"""
WITH {_LINES},
a AS (SELECT * FROM (SELECT *, max(regexp_matches(line, '^OA\s*\d+\.')::INT) OVER (PARTITION BY page ORDER BY pos) AS after FROM l) WHERE after = 0),
n AS (SELECT *, count(number) OVER (PARTITION BY page ORDER BY pos) AS nr FROM (SELECT *, nullif(regexp_extract(line, '^(\d+)\.\s', 1), '')::INT AS number FROM a))
SELECT page, max(number) AS number, trim(regexp_replace(string_agg(line, ' ' ORDER BY pos), '^\d+\.\s*', ''), ' ') AS idea FROM n WHERE nr > 0 AND line <> '' AND NOT regexp_matches(line, ':$') GROUP BY page, nr""")
def prose_ideas(spark, d):
    return prose.ideas(table(spark, d, "bases_pages"))


@query("prose_problems", f"""{_PROSE} SELECT page, 'numbers' AS problem FROM (SELECT page, list(number ORDER BY number) AS n FROM f GROUP BY page) WHERE n <> range(1, len(n) + 1)
UNION ALL SELECT DISTINCT page, 'no strand' FROM f WHERE strand IS NULL UNION ALL SELECT DISTINCT page, 'empty' FROM f WHERE statement = ''""")
def prose_problems(spark, d):
    return prose.problems(settle(prose.objectives(table(spark, d, "bases_pages"))))


@query("manifest", """
SELECT *, concat_ws('; ', CASE WHEN without_statement > 0 THEN 'objectives without a statement' END, CASE WHEN without_source > 0 THEN 'objectives without a source' END, CASE WHEN offerings < expected_offerings THEN 'offerings without objectives' END) AS limitations
FROM (SELECT count(*) AS objectives, count(DISTINCT offering_key) AS offerings, count(DISTINCT code) AS codes, count(*) FILTER (WHERE prioritized) AS prioritized, count(*) FILTER (WHERE statement IS NULL) AS without_statement, count(*) FILTER (WHERE source IS NULL) AS without_source, max(retrieved_at) AS last_retrieved FROM objectives),
  (SELECT count(DISTINCT offering_key) AS expected_offerings FROM offerings)""")
def manifest(spark, d):
    return exports.manifest(objectives(spark, d), table(spark, d, "offerings"))


_TITLE = "coalesce(nullif(trim(regexp_replace(subject_name, '(?i)\\s+(?:[1-8]\\s*[º°]?\\s*(?:Básico|Medio)|[12])\\s*$', '')), ''), trim(subject_name))"


@query("document_index", f"""
WITH o AS (SELECT offering_key, coalesce(track, 'otro') AS area, {_TITLE} AS title FROM offerings), n AS (SELECT offering_key, count(*) AS n FROM objectives GROUP BY offering_key)
SELECT concat_ws('_', area, {_SLUG.format('title', '_')}) AS document, title, count(DISTINCT o.offering_key) AS offerings, coalesce(sum(n), 0)::BIGINT AS objectives FROM o LEFT JOIN n ON o.offering_key = n.offering_key GROUP BY area, title""")
def document_index(spark, d):
    return exports.document_index(objectives(spark, d), table(spark, d, "offerings"))


@query("offering_lookup", "SELECT o.row_id, coalesce(f.subject_name, '?') AS subject, f.level_name AS level, CASE WHEN f.is_epja THEN 'adultos' WHEN f.track = 'tp' THEN 'tp' ELSE 'general' END AS area FROM objectives o LEFT JOIN offerings f USING (offering_key)")
def offering_lookup(spark, d):
    x = dimensions.lookup(objectives(spark, d), table(spark, d, "offerings"), {"offering_key": "offering_key"}, {"subject_name": "subject", "level_name": "level", "is_epja": "adult", "track": "track"}, {"subject": F.lit("?")})
    return dimensions.by_rule(x, [("adult", "adultos"), ("track = 'tp'", "tp")], "general", "area").select("row_id", "subject", "level", "area")


@query("child_counts", "SELECT f.offering_key, count(o.row_id) AS children FROM offerings f LEFT JOIN objectives o USING (offering_key) GROUP BY f.offering_key")
def child_counts(spark, d):
    return dimensions.child_counts(table(spark, d, "offerings").select("offering_key"), objectives(spark, d), "offering_key", "offering_key").select("offering_key", "children")


@query("search_highlighted", "SELECT row_id, regexp_replace(replace(replace(replace(replace(replace(statement, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#39;'), '(c[uúùûü][\\x{300}-\\x{36F}]*[eéèêë][\\x{300}-\\x{36F}]*n[\\x{300}-\\x{36F}]*t[\\x{300}-\\x{36F}]*[oóòôö][\\x{300}-\\x{36F}]*)', '<mark>\\1</mark>', 'gi') AS html FROM objectives WHERE contains(" + _FOLD.format("statement") + ", 'cuento')")
def search_highlighted(spark, d):
    return objectives(spark, d).where(F.contains(T.fold(F.col("statement")), F.lit("cuento"))).select("row_id", search.highlight(F.col("statement"), "cuénto").alias("html"))


@query("export_modules", """
SELECT source_pdf, module_number, '#### ' || concat_ws(' · ', 'Módulo ' || module_number, min(module_name), max(hours) || ' horas') || chr(10) ||
  string_agg(chr(10) || '**' || number || '.** ' || coalesce(statement, '') || coalesce(array_to_string(list_transform(list_filter(criteria, lambda c: c IS NOT NULL), lambda c: chr(10) || '- ' || c), ''), '') || chr(10), '' ORDER BY number, row_id) AS block
FROM expected_learnings WHERE number IS NOT NULL GROUP BY source_pdf, module_number""")
def export_modules(spark, d):
    return exports.modules_document(table(spark, d, "expected_learnings").where("number IS NOT NULL"))


from telarium import landed  # noqa: E402, F401  registers its queries
