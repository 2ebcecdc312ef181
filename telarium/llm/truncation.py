"""Text cut off by field limits, found in SQL alone.

Word trigrams are counted inside texts and at the ends of closed texts. The last trigram of a text
without a closing point is looked up; where it is frequent inside but almost never ends a text, the text is
cut. Trigrams that are too rare to tell back off to the last two words and then to the last one, judged in the same way;
a last word may also be none, but the beginning of frequent ones. Lengths at which a source's texts pile
up, and marks that stand for missing text, tell the rest.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A trigram or word is frequent inside from this count on; a pair, which says less of what may follow, from that one on.
FREQUENT, FREQUENT_PAIR = 20, 200
#: Share of its occurrences that a trigram or word may end texts and yet almost never ends one.
NEVER = 0.002
#: A word that is this much rarer than the words that begin with it is no word.
STUB = 0.03
#: A length is a limit if so many times more texts have it than the lengths around it, and so many at least.
PILE, PILE_ROWS = 8, 10
#: A source that marks this share of its texts as cut has the habit.
HABIT = 0.05
#: Words (of 62 bits) of the filter that keeps trigrams and pairs which no open text ends with from being shuffled.
FILTER_WORDS = 1 << 14

_WORDS = r"regexp_extract_all(lower(body), r'[\p{L}\p{N}]+', 0)"
# Marks that stand for missing text.
_MARK = r"(?:…|\[\s*(?:…|\.\.\.)\s*\]|\(\s*(?:…|\.\.\.)\s*\)|(?:\.\.\.|…)?\s*[\(\[](?:ver más|leer más|sigue|continúa|read more|cont\.)[\)\]])\s*$"
# What reprints append to a closed text.
_DECOR = r"(?:(?<=[.\s\)»”!])[;!]|!|(?<!\.)\.\.\.|\s)+$"

# The signs that marks and reprints are made of.
_SIGNS = " \t\n\r\f\x0b!;.…()[]»”"
#: Marks and what reprints append are looked for in all signs at the end and so many characters before them, more than the words of a mark have.
TAIL = 48

_BASE = rf"""
SELECT table_name, row_id, source, chars, bytes, marked, dotted, right(body, 1) AS e,
  length(body) - length(replace(body, '(', '')) > length(body) - length(replace(body, ')', ''))
    OR length(body) - length(replace(body, '«', '')) > length(body) - length(replace(body, '»', '')) AS unclosed, {_WORDS} AS w
FROM (
  SELECT *, concat(left(statement, ahead), regexp_replace(regexp_replace(tail, r'{_MARK}', ''), r'{_DECOR}', '')) AS body, tail RLIKE r'{_MARK}' AS marked, tail RLIKE r'\.\.\.\s*$' AS dotted
  FROM (SELECT *, chars - length(tail) AS ahead FROM (
    SELECT *, length(statement) AS chars, octet_length(statement) AS bytes, right(statement, length(statement) - length(rtrim('{_SIGNS}', statement)) + {TAIL}) AS tail FROM :rows WHERE statement RLIKE r'\S'))
)"""

_STATE = r"""
SELECT *, size(w) AS n, element_at(w, -1) AS last,
  CASE WHEN size(w) >= 3 THEN xxhash64(w[size(w) - 3], w[size(w) - 2], w[size(w) - 1]) END AS tri,
  CASE WHEN size(w) >= 2 THEN xxhash64(w[size(w) - 2], w[size(w) - 1]) END AS bi,
  CASE WHEN marked OR e = '\uFFFD' THEN 'cut'
       WHEN dotted THEN CASE WHEN e RLIKE r'[.!?．\)»"”\]]' THEN 'shut' ELSE 'dots' END
       WHEN e RLIKE r'[.!?．\)»"”\]]' THEN 'closed'
       WHEN e RLIKE r'[:,;«“¿¡\(\[–-]' OR unclosed THEN 'cut'
       ELSE 'open' END AS state
FROM :base WHERE size(w) > 0"""

_GRAMS = """
SELECT gram, count_if(NOT ends) AS inside, count_if(ends) AS ending
FROM (
  SELECT g.h AS gram, g.ends FROM :state
  LATERAL VIEW explode(concat(
    CASE WHEN n >= 3 THEN transform(sequence(0, n - 3), i -> named_struct('h', xxhash64(w[i], w[i + 1], w[i + 2]), 'ends', i = n - 3)) ELSE array() END,
    CASE WHEN n >= 2 THEN transform(sequence(0, n - 2), i -> named_struct('h', xxhash64(w[i], w[i + 1]), 'ends', i = n - 2)) ELSE array() END)) x AS g
  WHERE (NOT g.ends OR state = 'closed') AND getbit(element_at(:filter, CAST(pmod(g.h, :size) AS INT) + 1), CAST(pmod(shiftright(g.h, 40), 62) AS INT)) = 1
)
GROUP BY gram"""

_COUNTS = """
SELECT word, sum(inside) AS inside, sum(ending) AS ending
FROM (
  SELECT g.word, CAST(NOT g.ends AS INT) AS inside, CAST(g.ends AND state = 'closed' AS INT) AS ending FROM :state
  LATERAL VIEW explode(transform(sequence(0, n - 1), i -> named_struct('word', w[i], 'ends', i = n - 1))) x AS g
)
GROUP BY word"""

_STUBS = """
SELECT stub, sum(inside) AS longer FROM (
  SELECT explode(transform(sequence(1, length(word) - 1), i -> left(word, i))) AS stub, inside
  FROM :words WHERE inside >= :frequent AND length(word) BETWEEN 2 AND 40
) GROUP BY stub"""

_LIMITS = """
SELECT source, measure, len FROM (
  SELECT *, sum(rows) OVER (PARTITION BY source, measure ORDER BY len RANGE BETWEEN 5 PRECEDING AND 5 FOLLOWING) - rows AS around
  FROM (
    SELECT source, measure, len, count(*) AS rows
    FROM (SELECT source, explode(array(named_struct('m', 'chars', 'l', chars), named_struct('m', 'bytes', 'l', bytes))) AS x FROM :state) LATERAL VIEW inline(array(x)) y AS measure, len
    GROUP BY source, measure, len
  )
) WHERE rows >= :least AND rows * 10 > :pile * around"""

_FOUND = """
SELECT s.table_name, s.row_id, s.source,
  CASE WHEN s.state = 'cut' THEN 'stop'
       WHEN s.state IN ('dots', 'shut') AND h.habit THEN 'dots'
       WHEN s.state = 'shut' THEN NULL
       WHEN t.inside >= :frequent AND t.ending <= :never * (t.inside + t.ending) THEN 'trigram'
       WHEN b.inside >= :pair AND b.ending <= :never * (b.inside + b.ending) THEN 'bigram'
       WHEN c.inside >= :frequent AND c.ending <= :never * (c.inside + c.ending) THEN 'word'
       WHEN c.inside + c.ending <= :stub * p.longer THEN 'stub'
       WHEN s.chars_limit IS NOT NULL OR s.bytes_limit IS NOT NULL THEN 'limit' END AS reason
FROM :limited s
LEFT JOIN :habits h ON s.source <=> h.source
LEFT JOIN :grams t ON coalesce(s.tri, xxhash64(s.row_id, s.table_name)) = t.gram AND s.tri IS NOT NULL
LEFT JOIN :grams b ON coalesce(s.bi, xxhash64(s.row_id, s.table_name)) = b.gram AND s.bi IS NOT NULL
LEFT JOIN :words c ON s.last = c.word
LEFT JOIN :stubs p ON s.last = p.stub"""


# Plain points are a mark only where a source often marks what it cut; those behind an open end are such marks themselves.
_HABITS = "SELECT source, true AS habit FROM :state GROUP BY source HAVING count_if(marked OR state = 'dots') >= :least AND count_if(marked OR state = 'dots') >= :share * count(*)"

_LIMITED = """
SELECT o.*, a.len AS chars_limit, b.len AS bytes_limit FROM :open o
LEFT JOIN (SELECT * FROM :limits WHERE measure = 'chars') a ON o.source <=> a.source AND o.chars = a.len
LEFT JOIN (SELECT * FROM :limits WHERE measure = 'bytes') b ON o.source <=> b.source AND o.bytes = b.len"""

_SHARES = r"""
SELECT r.source, r.n_rows, coalesce(c.n_cut, 0) AS n_cut, coalesce(c.n_cut, 0) / r.n_rows AS share
FROM (SELECT source, count(*) AS n_rows FROM :rows WHERE statement RLIKE r'\S' GROUP BY source) r
LEFT JOIN (SELECT source, count(*) AS n_cut FROM :cut GROUP BY source) c ON r.source <=> c.source"""


def _sql(spark: SparkSession, text: str, **given: DataFrame | int | float | str) -> DataFrame:
    """spark.sql with :name for tables and values."""
    views = []
    for k, v in given.items():
        if isinstance(v, DataFrame):
            views.append(name := f"t_{uuid.uuid4().hex}")
            v.createOrReplaceTempView(name)
            v = name
        text = re.sub(rf":{k}\b", lambda _, v=v: str(v), text)
    out = spark.sql(text)
    for v in views:
        spark.catalog.dropTempView(v)
    return out


def rows_of(tables: list[tuple[str, DataFrame]]) -> DataFrame:
    out = None
    for name, df in tables:
        x = df.select(F.lit(name).alias("table_name"), F.col("row_id").cast("long").alias("row_id"), F.col("source").cast("string").alias("source"), F.col("statement").cast("string").alias("statement"))
        out = x if out is None else out.unionByName(x)
    return out


def cuts(tables: list[tuple[str, DataFrame]]) -> DataFrame:
    """(table_name, row_id, source, reason) of every cut text of the tables (row_id, source, statement).

    Null and blank texts are no cases; a null source is a source of its own. Rows of equal id are judged one by one.
    Statistics are counted over all rows and combined within tasks. Only trigrams and pairs that some open text may end with are
    shuffled; the filter for that has a fixed size and, when it is full, lets all pass.
    """
    from telarium.session import settle

    rows = rows_of(tables)
    spark = rows.sparkSession
    state = _sql(spark, _STATE, base=settle(_sql(spark, _BASE, rows=rows)))
    open_ = settle(_sql(spark, "SELECT table_name, row_id, source, chars, bytes, state, last, tri, bi FROM :state WHERE state <> 'closed'", state=state))
    grams = settle(_sql(spark, _GRAMS, state=state, filter=_filter(spark, open_), size=FILTER_WORDS))
    words = settle(_sql(spark, _COUNTS, state=state))
    stubs = _sql(spark, _STUBS, words=words, frequent=FREQUENT)
    limits = settle(_sql(spark, _LIMITS, state=state, least=PILE_ROWS, pile=PILE))
    habits = _sql(spark, _HABITS, state=state, least=PILE_ROWS, share=HABIT)
    limited = _sql(spark, _LIMITED, open=open_, limits=limits)
    return _sql(spark, _FOUND, limited=limited, habits=habits, grams=grams, words=words, stubs=stubs, frequent=FREQUENT, pair=FREQUENT_PAIR, never=NEVER, stub=STUB).where("reason IS NOT NULL")


def _filter(spark: SparkSession, open_: DataFrame) -> str:
    """FILTER_WORDS words as an SQL array; bit (h mod FILTER_WORDS, h >> 40 mod 62) is set if an open text ends with the trigram or pair h."""
    got = _sql(
        spark, "SELECT CAST(pmod(h, :size) AS INT) AS i, bit_or(shiftleft(1L, CAST(pmod(shiftright(h, 40), 62) AS INT))) AS b FROM :open LATERAL VIEW explode(array(tri, bi)) x AS h WHERE state IN ('open', 'dots') AND h IS NOT NULL GROUP BY 1",
        open=open_, size=FILTER_WORDS,
    ).collect()
    bits = {r.i: r.b for r in got}
    return f"array({', '.join(f'{bits.get(i, 0)}L' for i in range(FILTER_WORDS))})"


def by_source(tables: list[tuple[str, DataFrame]]) -> DataFrame:
    """(source, n_rows, n_cut, share): how often each source cuts; n_rows counts the rows with text."""
    return _sql(tables[0][1].sparkSession, _SHARES, rows=rows_of(tables), cut=cuts(tables))
