"""Duplicates hidden by formatting differences.

Canonicalize, hash to 128 bits, aggregate with map-side combining, check for collisions.
"""

from __future__ import annotations

import unicodedata as U
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telarium.operators.joining import lookup
from telarium.session import settle

#: Java regex of the parts of the code space whose characters composing may change.
MARKS = r"[\x{300}-\x{36F}\x{483}-\x{1FFF}\x{2126}\x{212A}\x{212B}\x{302A}-\x{30FF}\x{A66F}-\x{D7FF}\x{F900}-\x{10FFFF}]"


def composed(df: DataFrame, cols: list[str]) -> DataFrame:
    """df's columns cols (text) with their letters composed; rows without marks, nearly all, stay in the JVM."""
    df = df.select(*df.columns)
    odd = reduce(Column.__or__, (F.coalesce(F.col(c).rlike(MARKS), F.lit(False)) for c in cols))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([x and U.normalize("NFC", x) for x in c.to_pylist()], c.type) if n in cols else c for n, c in zip(b.schema.names, b.columns)], schema=b.schema)

    return df.where(~odd).unionByName(df.where(odd).mapInArrow(run, df.schema))


def letters(c: Column) -> Column:
    """Letters and digits of c in lower case; accents stay."""
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", "")


def same_fields(c: Column) -> Column:
    """One form of a JSON text: without white space, fields of every object by name. Text that is no JSON stands for itself.

    4 and "4" differ, as do a missing field and one that is null.
    """
    return F.coalesce(F.to_json(F.try_parse_json(c)), c)


def canonical(key_cols: list[Column]) -> Column:
    """One string of all key parts; a null part differs from an empty one only if the caller keeps it so."""
    return F.concat_ws("\u0001", *[F.coalesce(k, F.lit("")) for k in key_cols])


def copies(df: DataFrame, id_col: str, statement: str, others: list[tuple[str, Callable[[Column], Column]]]) -> tuple[DataFrame, DataFrame]:
    """(one row for each set: keep_id, n_copies; one row for each further copy: keep_id, copy_id).

    Rows are copies if the letters and digits of ``statement`` and all ``others`` (columns that
    are canonical already) are equal. Rows whose statement is null or has no letter are in no
    set. The smallest id is kept; ids that repeat count as rows of their own, and a row whose id
    equals the kept one gives no further row. Other columns play no part.

    The keys are two 64-bit hashes with different inputs; each group also carries the extremes of a third hash and of
    the length. Where those differ, two texts share a key, and the group is keyed by its text.
    Aggregation is combined before the shuffle, so a hot group sends one row per task. Copies
    find their group through a join; those of hot groups meet it in a broadcast and are no part of what is shuffled.
    Letters are composed first, so an accent counts however it is written. ``others`` are named by (column, form).
    """
    cols = [statement, *(c for c, _ in others)]
    df = composed(df.select(F.col(id_col).cast("long").alias("id"), *(F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(cols))), [f"c{i}" for i in range(len(cols))])
    forms = [letters(F.col("c0")), *(f(F.col(f"c{i}")) for i, (_, f) in enumerate(others, 1))]
    rows = (
        df.where(F.col("c0").rlike(r"\p{L}"))
        .select("id", canonical(forms).alias("c"))
        .select("id", F.xxhash64("c").alias("h1"), F.xxhash64(F.lit("2"), F.reverse("c")).alias("h2"), F.crc32("c").alias("h3"), F.length("c").alias("n"), "c")
    )
    return grouped(settle(rows.drop("c")), rows)


def grouped(keys: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The result of copies() from a settled table of keys (id, h1, h2, h3, n); rows has them with their text c, which is asked for only if two texts share a key."""
    groups = keys.groupBy("h1", "h2").agg(
        F.min("id").alias("keep_id"), F.count("*").alias("n_rows"),
        F.min("h3").alias("a"), F.max("h3").alias("b"), F.min("n").alias("d"), F.max("n").alias("e"),
    ).where("n_rows > 1")
    return _resolve(rows, keys, groups)


def _resolve(rows: DataFrame, keys: DataFrame, groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    groups = settle(groups)
    many, worst = groups.agg(F.sum("n_rows"), F.max((F.col("a") != F.col("b")) | (F.col("d") != F.col("e")))).first()
    if worst:  # never seen; the groups that share a key are keyed by their text
        bad = groups.where("a <> b OR d <> e").select("h1", "h2")
        again = rows.join(bad, ["h1", "h2"], "left_semi").withColumn("t", F.col("c"))
        regrouped = again.groupBy("h1", "h2", "t").agg(F.min("id").alias("keep_id"), F.count("*").alias("n_rows")).where("n_rows > 1")
        extra = again.join(regrouped, ["h1", "h2", "t"]).where("id <> keep_id").select("keep_id", F.col("id").alias("copy_id"))
        kept_extra = regrouped.select("keep_id", (F.col("n_rows")).alias("n_copies"))
        groups = groups.where("a = b AND d = e")
    found = lookup(keys.select("id", "h1", "h2"), groups.select("h1", "h2", "keep_id", "n_rows"), ["h1", "h2"], "n_rows", many or 0)
    out = found.where("id <> keep_id").select("keep_id", F.col("id").alias("copy_id"))
    kept = groups.select("keep_id", F.col("n_rows").alias("n_copies"))
    return (kept.unionByName(kept_extra), out.unionByName(extra)) if worst else (kept, out)


def objective_copies(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Copies among rows of objectives: statement and code."""
    return copies(df, "row_id", "statement", [("code", letters)])


def table_row_copies(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Copies among rows of table_rows: statement, code and the fields of attrs."""
    return copies(df, "row_id", "statement", [("code", letters), ("attrs", same_fields)])
