"""Search: postings, ranked and boolean search, facets, progression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telarium.functions import text as T


def postings(df: DataFrame, key: str, fields: list[Column]) -> DataFrame:
    """(token, key): distinct tokens of all fields."""
    return df.select(F.col(key), F.explode(F.array_distinct(F.flatten(F.array(*[T.tokens(f) for f in fields])))).alias("token")).select("token", key)


def _query_tokens(query: str) -> list[str]:
    import re
    import unicodedata

    folded = "".join(c for c in unicodedata.normalize("NFD", query) if unicodedata.category(c) != "Mn").lower()
    return list(dict.fromkeys(re.findall("[a-z0-9]+", folded)))


def matching(post: DataFrame, key: str, query: str) -> DataFrame:
    """Keys that have every token of the query; tokens of three letters or more also match as prefixes. A query without tokens matches nothing.

    Conditions are pushed to the scan of the postings; a key is counted once for each query token.
    """
    q = _query_tokens(query)
    hit = lambda t: F.col("token").startswith(t) if len(t) >= 3 else F.col("token") == t
    if not q:
        return post.select(key).limit(0)
    any_ = hit(q[0])
    for t in q[1:]:
        any_ = any_ | hit(t)
    found = post.where(any_).groupBy(key).agg(*[F.max(hit(t).cast("int")).alias(f"h{i}") for i, t in enumerate(q)])
    for i in range(len(q)):
        found = found.where(f"h{i} = 1")
    return found.select(key)


# Weights of a token by where it stands, and of a prioritized record.
WEIGHTS = {"code": 40, "start": 12, "statement": 10, "keywords": 5, "strand": 3, "indicators": 2, "prioritized": 1}


def score(query: str, code: Column, statement: Column, keywords: Column, strand: Column, indicators: Column, prioritized: Column) -> Column:
    """Weight of a hit: code 40, start of the statement 12, statement 10, keywords 5, strand 3, indicators 2 for each token; 1 for prioritized."""
    c, s, k, st, i = (T.fold(x) for x in (code, statement, keywords, strand, indicators))
    g = WEIGHTS
    total = F.coalesce(prioritized, F.lit(False)).cast("int") * g["prioritized"]
    for t in _query_tokens(query):
        w = lambda cond, n: F.when(cond, n).otherwise(0)
        total = total + w(F.contains(c, F.lit(t)), g["code"]) + w(F.startswith(s, F.lit(t)), g["start"]) + w(F.contains(s, F.lit(t)), g["statement"]) + w(F.contains(k, F.lit(t)), g["keywords"]) + w(F.contains(st, F.lit(t)), g["strand"]) + w(F.contains(i, F.lit(t)), g["indicators"])
    return total


def substring(df: DataFrame, query: str, fields: list[Column]) -> DataFrame:
    """Rows in whose fields, joined by spaces, the folded query stands; an empty query matches all."""
    return df.where(F.contains(T.fold(F.concat_ws(" ", *fields)), T.fold(F.lit(query))))


def bm25(df: DataFrame, key: str, text: Column, query: str, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """(key, score) of rows with any token of the query. The corpus' counts are one row, read first."""
    q = _query_tokens(query)
    toks = df.select(key, T.tokens(text).alias("t")).select(key, F.size("t").alias("len"), F.filter("t", lambda x: x.isin(q)).alias("t"))
    n, avg, *df = toks.agg(F.count("*"), F.avg("len"), *[F.count_if(F.array_contains("t", x)) for x in q]).first()
    total = F.lit(0.0)
    for w, d in zip(q, df):
        tf = F.size("t") - F.size(F.array_remove("t", w))
        idf = F.log(F.lit(1 + (n - d + 0.5) / (d + 0.5)))
        total = total + idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("len") / F.lit(avg or 1.0)))
    return toks.where(F.size("t") > 0).select(key, total.alias("score"))


def facets(df: DataFrame, cols: list[str]) -> DataFrame:
    """(facet, value, n) of several columns in one pass; null values are left out."""
    x = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in cols])).alias("f")).select("f.*").where("value IS NOT NULL")
    return x.groupBy("facet", "value").agg(F.count("*").alias("n"))


def progression(df: DataFrame, key: str = "row_id", asked: DataFrame | None = None) -> DataFrame:
    """(key, other): records that share the code, or strand, subject and number at another level, with each of ``asked`` (all by default). Two equi-joins.

    Codes that hold many records make as many pairs; ask for some records, or give records that are distinct.
    """
    a, b = (df if asked is None else asked).alias("a"), df.alias("b")
    same = a.join(b, (F.col("a.code") == F.col("b.code")) & (F.col(f"a.{key}") != F.col(f"b.{key}"))).select(F.col(f"a.{key}").alias(key), F.col(f"b.{key}").alias("other"))
    strand = a.join(b, (F.col("a.strand_eje") == F.col("b.strand_eje")) & (F.col("a.subject_id") == F.col("b.subject_id")) & (F.col("a.oa_number") == F.col("b.oa_number")) & (F.col("a.level_id") != F.col("b.level_id"))).select(
        F.col(f"a.{key}").alias(key), F.col(f"b.{key}").alias("other"))
    return same.unionByName(strand).distinct()


def explain(query: str, **fields: Column) -> Column:
    """Names of the fields in which any token of the query stands."""
    q = _query_tokens(query)
    any_ = lambda c: F.exists(F.array(*map(F.lit, q)), lambda t: F.contains(c, t)) if q else F.lit(False)
    return F.array_compact(F.array(*[F.when(any_(T.fold(c)), F.lit(n)) for n, c in fields.items()]))


def excerpt(c: Column, query: str, before: int = 60, after: int = 90) -> Column:
    """The part of a text around the first token of the query that it holds, null if none."""
    out = F.lit(None).cast("string")
    for t in reversed(_query_tokens(query)):
        at = F.instr(T.fold(c), t)
        lo = F.greatest(F.lit(1), at - before)
        hi = at + len(t) + after
        piece = F.concat(F.when(lo > 1, "…").otherwise(""), F.trim(F.substring(c, lo, hi - lo)), F.when(hi <= F.length(c), "…").otherwise(""))
        out = F.when(at > 0, piece).otherwise(out)
    return out


def top(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def code_order(c: Column) -> Column:
    """Key that sorts codes by their numbers: every number padded to ten digits."""
    parts = F.regexp_extract_all(F.lower(c), F.lit(r"\d+|\D+"), F.lit(0))
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike(r"^\d+$"), F.lpad(p, 10, "0")).otherwise(p)), "")


def first_by(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    return df.withColumn("_k", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_k = 1").drop("_k")


def highlight(c: Column, query: str, least: int = 2) -> Column:
    """Text as HTML in which the query's tokens of ``least`` letters or more are marked, whatever their accents and case; a longer token wins over one that it contains."""
    toks = sorted((t for t in _query_tokens(query) if len(t) >= least), key=lambda t: (-len(t), t))
    safe = T.escape_html(F.coalesce(c, F.lit("")))
    if not toks:
        return safe
    variants = {}
    for a, b in zip(T._FROM, T._TO):
        variants.setdefault(b.lower(), set()).add(a.lower())
    one = lambda ch: "[" + ch + "".join(sorted(variants.get(ch, ()))) + "][\\u0300-\\u036f]*" if ch.isalpha() else ch
    pattern = "|".join("".join(map(one, t)) for t in toks)
    return F.regexp_replace(safe, f"(?iu)(?<!&)({pattern})(?![a-z]{{0,4}};)", "<mark>$1</mark>")


def grep(df: DataFrame, text: str, level: str | None = None, subject: str | None = None, category: str | None = None, limit: int = 20, indicators: Column | None = None) -> DataFrame:
    """The first ``limit`` rows by row_id in whose statement, code, id, keywords or indicators the text stands; subject is a part of the id. Filters reach the scan."""
    for cond, given in ((F.col("level_id") == level, level), (F.contains(F.col("subject_id"), F.lit(subject)), subject), (F.col("category") == category, category)):
        df = df.where(cond) if given else df
    fields = [F.col("statement"), F.col("code"), F.col("oa_id"), F.array_join("keywords", " ")] + ([indicators] if indicators is not None else [])
    return top(substring(df, text, fields), [F.col("row_id")], limit)
