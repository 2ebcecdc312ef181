"""Objectives of prose pages: numbered lines with lists below them and the strand in parentheses at the end.

Input: pages(page_id, text). Lines are exploded once and put together by windows; the state of the reading is a running
count, so there is no row-by-row code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telarium.functions import text as T

# Starts of objectives and of items, and the strand at the end.
_START, _ITEM = r"^OA\s*(\d+)\.\s*", r"^(?:[-•›‣●*]|\ty)\s*"
_STRAND = r"\(([^()]{2,80})\)\s*$"


def objectives(pages: DataFrame, id_col: str = "page_id", text_col: str = "text") -> DataFrame:
    """(page, number, statement, strand): statement with its items as lines "- item", strand null where none is printed.

    Only a parenthesis of up to six words at the very end that doesn't close with a point is a strand. Pages that are null
    or have no objective give no row; text before the first objective is none.
    """
    line = F.regexp_replace("line", r"[\r\s]+$", "")
    x = pages.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("page"), F.posexplode(F.split(F.col(text_col), "\n")).alias("pos", "line")).select("page", "pos", line.alias("line")).where("line <> ''")
    x = x.withColumn("number", F.nullif(F.regexp_extract("line", _START, 1), F.lit("")).cast("int"))
    w = Window.partitionBy("page").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = x.withColumn("nr", F.count("number").over(w)).where("nr > 0")
    x = x.withColumn("body", F.trim(F.regexp_replace(F.regexp_replace("line", _START, ""), _ITEM, ""))).withColumn("opens", F.col("number").isNotNull() | F.col("line").rlike(_ITEM))
    x = x.withColumn("part", F.sum(F.col("opens").cast("int")).over(Window.partitionBy("page", "nr").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    parts = x.groupBy("page", "nr", "part").agg(F.max("number").alias("number"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "body"))), lambda r: r["body"]), " ").alias("text"))
    whole = parts.groupBy("page", "nr").agg(F.max("number").alias("number"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "text"))), lambda r: F.when(r["part"] == 1, r["text"]).otherwise(F.concat(F.lit("- "), r["text"]))), "\n").alias("t"))
    label = F.nullif(F.regexp_extract("t", _STRAND, 1), F.lit(""))
    is_strand = label.isNotNull() & (F.size(F.split(label, r"\s+")) <= 6) & ~label.endswith(".")
    return whole.select("page", "number", F.trim(F.when(is_strand, F.regexp_replace("t", r"\s*" + _STRAND, "")).otherwise(F.col("t"))).alias("statement"), F.when(is_strand, F.trim(label)).alias("strand"))


def problems(found: DataFrame) -> DataFrame:
    """(page, problem): numbers that don't run from 1, statements without a strand or without text."""
    w = F.array_sort(F.collect_list("number"))
    runs = found.groupBy("page").agg(w.alias("n")).where(~(F.col("n") == F.sequence(F.lit(1), F.size("n")))).select("page", F.lit("numbers").alias("problem"))
    return runs.unionByName(found.where("strand IS NULL").select("page", F.lit("no strand").alias("problem")).distinct()).unionByName(found.where("statement = ''").select("page", F.lit("empty").alias("problem")).distinct())


def ideas(pages: DataFrame, id_col: str = "page_id", text_col: str = "text") -> DataFrame:
    """(page, number, idea): the numbered list before the first objective; a line that opens no number continues it."""
    x = pages.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("page"), F.posexplode(F.split(F.col(text_col), "\n")).alias("pos", "line")).select("page", "pos", F.regexp_replace("line", r"[\r\s]+$", "").alias("line"))
    w = Window.partitionBy("page").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = x.withColumn("after", F.max(F.col("line").rlike(r"^OA\s*\d+\.|:$").cast("int") * F.col("line").rlike(r"^OA\s*\d+\.").cast("int")).over(w)).where("after = 0")
    x = x.withColumn("number", F.nullif(F.regexp_extract("line", r"^(\d+)\.\s", 1), F.lit("")).cast("int")).withColumn("nr", F.count("number").over(w)).where("nr > 0 AND line <> '' AND NOT line RLIKE ':$'")
    g = x.groupBy("page", "nr").agg(F.max("number").alias("number"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda r: r["line"]), " ").alias("t"))
    return g.select("page", "number", F.trim(F.regexp_replace("t", r"^\d+\.\s*", "")).alias("idea"))
