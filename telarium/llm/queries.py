"""Registry of the queries of this subpackage and of their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telarium.llm import copies, lookalike, neardup, packing, residue, scans, tokens, truncation
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


_CANON = "regexp_replace(lower(nfc_normalize({0})), '[^\\p{{L}}\\p{{N}}]+', '', 'g')"
_P6_SETS = f"""
WITH r AS (
  SELECT 'objectives' AS table_name, row_id, {_CANON.format('statement')} AS s, coalesce({_CANON.format('code')}, '') AS k, '' AS a
  FROM objectives WHERE regexp_matches(statement, '\\p{{L}}')
  UNION ALL
  SELECT 'table_rows', row_id, {_CANON.format('statement')}, coalesce({_CANON.format('code')}, ''),
    coalesce((SELECT string_agg(key || '=' || value::VARCHAR, ',' ORDER BY key) FROM json_each(attrs::JSON)), '')
  FROM table_rows WHERE regexp_matches(statement, '\\p{{L}}')
), g AS (SELECT *, min(row_id) OVER w AS keep_id, count(*) OVER w AS n FROM r WINDOW w AS (PARTITION BY table_name, s, k, a))
"""

# The consistent form in SQL, for comparison: the same fixed tables, applied by translate and regular expressions.
_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F)), "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F))
_GREEK = {k: v[0] for k, v in lookalike.LOOKALIKES.items() if "\u0370" <= k <= "\u03ff" and k not in "οΟ"}
_OTHERS = {k: v[0] for k, v in lookalike.LOOKALIKES.items() if k not in _GREEK and not (k.isascii())}
_GONE = "[\\x{AD}\\x{200B}-\\x{200F}\\x{202A}-\\x{202E}\\x{2060}-\\x{2064}\\x{FEFF}]"
_SPACES = "[\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{202F}\\x{205F}\\x{3000}]"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _consistent_sql(c: str) -> str:
    c = f"regexp_replace(regexp_replace({c}, '{_GONE}', '', 'g'), '{_SPACES}', ' ', 'g')"
    c = f"translate(translate({c}, {_quoted(_WIDE[0])}, {_quoted(_WIDE[1])}), {_quoted(''.join(_OTHERS) + '‐‑')}, {_quoted(''.join(_OTHERS.values()) + '--')})"
    for a, b in (("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl")):
        c = f"replace({c}, '{a}', '{b}')"
    for a, b in _GREEK.items():
        c = f"regexp_replace(regexp_replace({c}, '([\\p{{L}}\\p{{M}}]){a}', '\\1{b}', 'g'), '{a}(\\p{{L}})', '{b}\\1', 'g')"
    return f"nfc_normalize({c})"



def _p6(spark: SparkSession, d: str) -> list[tuple[str, DataFrame, DataFrame]]:
    return [
        ("objectives", *copies.objective_copies(table(spark, d, "objectives"))),
        ("table_rows", *copies.table_row_copies(table(spark, d, "table_rows"))),
    ]


@query("p6_found", _P6_SETS + "SELECT table_name, keep_id, row_id AS copy_id FROM g WHERE row_id <> keep_id")
def p6_found(spark: SparkSession, d: str) -> DataFrame:
    a, b = (x.select(F.lit(n).alias("table_name"), "keep_id", "copy_id") for n, _, x in _p6(spark, d))
    return a.unionByName(b)


@query("p6_counts", _P6_SETS + "SELECT table_name, keep_id, n AS n_copies FROM g WHERE n > 1 AND row_id = keep_id")
def p6_counts(spark: SparkSession, d: str) -> DataFrame:
    a, b = (x.select(F.lit(n).alias("table_name"), "keep_id", "n_copies") for n, x, _ in _p6(spark, d))
    return a.unionByName(b)


def _p5(spark: SparkSession, d: str) -> list[tuple[str, DataFrame]]:
    return [(n, table(spark, d, n)) for n in ("objectives", "bases_objectives")]


@query("p5_found", " UNION ALL ".join(f"SELECT '{n}' AS table_name, row_id FROM {n} WHERE statement <> {_consistent_sql('statement')}" for n in ("objectives", "bases_objectives")))
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.changed(_p5(spark, d)).select("table_name", "row_id")


@query("p5_text", " UNION ALL ".join(f"SELECT '{n}' AS table_name, row_id, {_consistent_sql('statement')} AS statement FROM {n}" for n in ("objectives", "bases_objectives")))
def p5_text(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.normalized(_p5(spark, d))


@query("p7_ids")
def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode(table(spark, d, "documents"))


@query("p8_packed")
def p8_packed(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(tokens.lengths(table(spark, d, "documents")), table(spark, d, "containers"))


@query("p8_fill")
def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.fills(p8_packed(spark, d), table(spark, d, "containers"))


@query("p4_found", f"""
WITH n AS (SELECT row_id, {_CANON.format('statement')} AS c, list_distinct(regexp_extract_all(lower(strip_accents({_consistent_sql('statement')})), '[\\p{{L}}\\p{{N}}]+')) AS ws FROM objectives WHERE regexp_matches(statement, '\\p{{L}}')),
w AS (SELECT row_id, c, len(ws) AS n, unnest(ws) AS w FROM n),
p AS (SELECT a.row_id AS row_a, b.row_id AS row_b, a.n + b.n AS total, count(*) AS shared FROM w a JOIN w b ON a.w = b.w AND a.row_id < b.row_id AND a.c <> b.c GROUP BY ALL)
SELECT row_a, row_b FROM p WHERE shared >= 0.7 * (total - shared)""")
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    pairs, dup = neardup.similar(table(spark, d, "objectives"))
    return neardup.expand(settle(pairs), dup)


@query("p9_found")
def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return residue.residue(table(spark, d, "documents")).select("doc_id")


@query("p9_templates")
def p9_templates(spark: SparkSession, d: str) -> DataFrame:
    return residue.templates(table(spark, d, "documents"))


def _p1(spark: SparkSession, d: str) -> list[tuple[str, DataFrame]]:
    return [(n, table(spark, d, n)) for n in ("objectives", "raw_objectives")]


@query("p1_found")
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return truncation.cuts(_p1(spark, d)).select("table_name", "row_id")


@query("p1_sources")
def p1_sources(spark: SparkSession, d: str) -> DataFrame:
    return truncation.by_source(_p1(spark, d))


def _p2(spark: SparkSession, d: str) -> DataFrame:
    return scans.read(table(spark, d, "bases_pages"), [("table_rows", table(spark, d, "table_rows"), "row_id", "indicators"), ("expected_learnings", table(spark, d, "expected_learnings"), "row_id", "criteria")])


@query("p2_found")
def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return scans.found(_p2(spark, d))


@query("p2_text")
def p2_text(spark: SparkSession, d: str) -> DataFrame:
    return scans.repaired(_p2(spark, d))
