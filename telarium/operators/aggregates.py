"""Counts and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def by_level_and_category(df: DataFrame) -> DataFrame:
    return df.groupBy("level_id", "category").agg(F.count("*").alias("n"))


def totals(df: DataFrame) -> DataFrame:
    """One row with the counters of a build."""
    return df.agg(
        F.count("*").alias("objectives"), F.count_if(F.col("category") == "conocimiento").alias("conocimiento"), F.count_if(F.col("category") == "habilidad").alias("habilidad"),
        F.count_if(F.col("category") == "actitud").alias("actitud"), F.countDistinct("offering_key").alias("offerings"), F.countDistinct("subject_id").alias("subjects"),
        F.countDistinct("level_id").alias("levels"), F.countDistinct("code").alias("codes"),
    )


def indicator_coverage(rows: DataFrame) -> DataFrame:
    """For each code: rows, rows with indicators, indicators."""
    n = F.size(F.coalesce("indicators", F.array().cast("array<string>")))
    return rows.groupBy("code").agg(F.count("*").alias("rows"), F.count_if(n > 0).alias("with_indicators"), F.sum(n.cast("long")).alias("indicators"))


def most_prioritized(df: DataFrame, offerings: DataFrame, least: int, top: int) -> DataFrame:
    """Offerings with the most prioritized objectives: a top-k report."""
    o = offerings.select("offering_key", "subject_name", "level_name")
    g = df.groupBy("offering_key").agg(F.count_if("prioritized").alias("prioritized"), F.count("*").alias("total")).where(F.col("prioritized") >= least)
    return g.join(o, "offering_key").orderBy(F.desc("prioritized"), "offering_key").limit(top)


def modules_with_criteria(learnings: DataFrame) -> DataFrame:
    """Modules with the number of their learnings and criteria."""
    n = F.size(F.coalesce("criteria", F.array().cast("array<string>"))).cast("long")
    return learnings.groupBy("source_pdf", "module_number").agg(F.max("hours").alias("hours"), F.countDistinct("number").alias("learnings"), F.sum(n).alias("criteria"))
