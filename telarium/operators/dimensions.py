"""Lookups in small dimension tables, with a size check before anything is broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows and bytes of a dimension that are broadcast at most; a larger one is joined by shuffling.
SMALL, BYTES = 100_000, 64 << 20


def lookup(df: DataFrame, dim: DataFrame, on: dict[str, str], take: dict[str, str], default: dict[str, Column] | None = None) -> DataFrame:
    """df with columns of dim: on maps columns of df to keys of dim, take maps columns of dim to new names.

    Keys of dim must be unique. Unknown and null keys give the default, null if there is none.
    """
    keys = {v: f"_k{i}" for i, v in enumerate(on.values())}
    d = dim.select(*[F.col(k).alias(n) for k, n in keys.items()], *[F.col(c).alias(f"_t_{c}") for c in take])
    n, size = d.limit(SMALL + 1).select(sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in d.columns), F.lit(8)).alias("b")).agg(F.count("*"), F.sum("b")).first()
    if n <= SMALL and (size or 0) <= BYTES:
        d = F.broadcast(d)
    cond = F.lit(True)
    for left, right in on.items():
        cond = cond & (F.col(left) == F.col(keys[right]))
    out = df.join(d, cond, "left")
    default = default or {}
    return out.select(*[c for c in df.columns if c not in take.values()], *[F.coalesce(F.col(f"_t_{c}"), default.get(n, F.lit(None))).alias(n) for c, n in take.items()])


def expand_tokens(df: DataFrame, tokens: str, groups: dict[str, list[str]], known: list[str], name: str = "levels") -> DataFrame:
    """df with the list of tokens upper-cased, group names replaced by their members, repeats dropped; an unknown token raises an error."""
    t = F.transform(F.col(tokens), lambda x: F.upper(F.trim(x)))
    table = {**{g: m for g, m in groups.items()}, **{k: [k] for k in known}}
    m = F.create_map(*[y for k, v in table.items() for y in (F.lit(k), F.array(*map(F.lit, v)))])
    each = F.transform(t, lambda x: F.coalesce(m[x], F.raise_error(F.concat(F.lit("unknown token: "), x)).cast("array<string>")))
    return df.withColumn(name, F.array_distinct(F.flatten(each)))


def by_rule(df: DataFrame, rules: list[tuple[str, str]], otherwise: str, name: str) -> DataFrame:
    """df with a label: that of the first SQL condition that holds."""
    label = None
    for cond, value in rules:
        label = F.when(F.expr(cond), value) if label is None else label.when(F.expr(cond), value)
    return df.withColumn(name, F.lit(otherwise) if label is None else label.otherwise(otherwise))


def child_counts(parents: DataFrame, children: DataFrame, key: str, parent_key: str, name: str = "children") -> DataFrame:
    """parents with the number of their children, 0 where there are none."""
    c = children.where(F.col(parent_key).isNotNull()).groupBy(F.col(parent_key).alias("_p")).agg(F.count("*").alias("_n"))
    return parents.join(c, F.col(key) == F.col("_p"), "left").select(*parents.columns, F.coalesce("_n", F.lit(0)).alias(name))


def tree_ids(parents: DataFrame, children: DataFrame, prefix: str) -> DataFrame:
    """(id, base, label, number, statement) of children under the parents that stay.

    Of parents with one base and one title (without case, accents and signs) the one with most children stays, then the
    newest, then the first; children of the others are left out. A child without a number takes its place in the base.
    parents(pid, base, title, created), children(cid, parent, number, statement, ord).
    """
    from pyspark.sql import Window

    from telarium.functions.text import slugify
    from telarium.operators.merging import best_by_rank

    p = child_counts(parents.withColumn("slug", slugify(F.col("title"))), children, "pid", "parent")
    p = best_by_rank(p, ["base", "slug"], [F.desc("children"), F.desc_nulls_last("created"), F.col("pid")])
    x = children.join(p.select("pid", "base", "title", "slug"), F.col("parent") == F.col("pid"))
    n = F.coalesce(F.nullif(F.regexp_extract(F.col("number").cast("string"), r"\d+", 0), F.lit("")).cast("int"), F.row_number().over(Window.partitionBy("base").orderBy("ord", "cid")))
    x = x.withColumn("n", n)
    two = F.when(F.col("n") > 99, F.col("n").cast("string")).otherwise(F.lpad(F.col("n").cast("string"), 2, "0"))
    return x.select(F.concat_ws("_", F.lit(prefix), F.upper("base"), F.upper("slug"), two).alias("id"), "base", F.col("title").alias("label"), F.col("n").alias("number"), "statement")
