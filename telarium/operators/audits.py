"""Audits of a table of objectives, as plain relational queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telarium.functions import text as T


def flagged(df: DataFrame) -> DataFrame:
    """(row_id, problem): one row for each finding in a statement."""
    return df.select("row_id", F.explode(T.text_findings(F.col("statement"))).alias("problem"))


def findings_by_problem(df: DataFrame) -> DataFrame:
    return flagged(df).groupBy("problem").agg(F.count("*").alias("n"))


def _keyed(df: DataFrame) -> DataFrame:
    return df.select("row_id", "oa_id", "code", "level_id", "subject_id", F.concat_ws("/", "level_id", "subject_id").alias("scope"), T.normalize_statement(F.col("statement")).alias("norm"))


def same_text_different_codes(df: DataFrame) -> DataFrame:
    """Sets of one offering and one text with several codes; a null code counts as none."""
    return _keyed(df).groupBy("scope", "norm").agg(F.count("*").alias("n"), F.countDistinct("code").alias("n_codes")).where("n > 1 AND n_codes > 1")


def code_classes(df: DataFrame) -> DataFrame:
    """Every code used more than once, with its class.

    different_text: several texts in one offering; scoped_to_subject: several texts in several offerings; shared_expected and
    shared_unexpected: one text at several levels, of third and fourth grade of secondary school or others; same_record: the rest.
    """
    g = _keyed(df).where("code <> ''").groupBy("code").agg(
        F.count("*").alias("n"), F.countDistinct("norm").alias("n_texts"), F.countDistinct("scope").alias("n_scopes"), F.countDistinct("level_id").alias("n_levels"),
        F.count_if(~F.coalesce(F.col("level_id"), F.lit("")).isin("3_medio", "4_medio")).alias("n_other"),
    ).where("n > 1")
    kind = (
        F.when((F.col("n_texts") > 1) & (F.col("n_scopes") == 1), "different_text").when(F.col("n_texts") > 1, "scoped_to_subject")
        .when((F.col("n_levels") > 1) & (F.col("n_other") == 0), "shared_expected").when(F.col("n_levels") > 1, "shared_unexpected").otherwise("same_record")
    )
    return g.select("code", "n", "n_texts", "n_scopes", "n_levels", kind.alias("class"))


def duplicate_ids(df: DataFrame) -> DataFrame:
    """Ids used more than once; conflicting if their texts differ."""
    return _keyed(df).where("oa_id IS NOT NULL").groupBy("oa_id").agg(F.count("*").alias("n"), F.countDistinct("norm").alias("n_texts")).where("n > 1").select("oa_id", "n", (F.col("n_texts") > 1).alias("conflicting"))


def routes_used_twice(df: DataFrame) -> DataFrame:
    """Source addresses that more than one offering uses."""
    return df.where("source_url IS NOT NULL").groupBy("source_url").agg(F.countDistinct("offering_key").alias("n")).where("n > 1")


def provenance(df: DataFrame) -> DataFrame:
    """(problem, n): rows without a source, an address or a time of retrieval; the first that is missing counts."""
    p = F.when(F.col("source").isNull(), "no_source").when(F.col("source_url").isNull(), "no_source_url").when(F.col("retrieved_at").isNull(), "no_retrieved_at")
    return df.select(p.alias("problem")).where("problem IS NOT NULL").groupBy("problem").agg(F.count("*").alias("n"))


def status_without_source(df: DataFrame, known: list[str]) -> DataFrame:
    """Rows whose status is outside the vocabulary, or asserted without a source."""
    bad = F.when(F.col("curriculum_status").isNull(), "missing").when(~F.col("curriculum_status").isin(known), "unknown").when((F.col("curriculum_status") != "desconocido") & F.col("source").isNull(), "unsourced")
    return df.select("row_id", bad.alias("problem")).where("problem IS NOT NULL")


def regression(now: DataFrame, before: DataFrame, key: str) -> DataFrame:
    """Keys added and removed between two builds."""
    a, b = now.select(F.col(key).alias("k")).where("k IS NOT NULL").distinct(), before.select(F.col(key).alias("k")).where("k IS NOT NULL").distinct()
    return a.join(b, "k", "left_anti").select("k", F.lit("added").alias("change")).unionByName(b.join(a, "k", "left_anti").select("k", F.lit("removed").alias("change")))


def violations(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """(row_id, rule): rows that break an expectation, each a SQL condition; a null outcome breaks it too. One scan for all rules."""
    found = F.array_compact(F.array(*[F.when(~F.coalesce(F.expr(cond), F.lit(False)), F.lit(name)) for name, cond in rules.items()]))
    return df.select("row_id", F.explode(found).alias("rule"))


def flags_without(df: DataFrame, flag: str, needed: str, group: str) -> DataFrame:
    """(group, flagged, without_metadata): flagged rows, and those of them that lack what a flag must come with."""
    return df.where(F.col(flag)).groupBy(group).agg(F.count("*").alias("flagged"), F.count_if(F.col(needed).isNull()).alias("without_metadata"))


def report(found: DataFrame, rule: str, key: str, most: int) -> DataFrame:
    """(rule, n, examples): how often each rule is broken, with its first ``most`` keys; nothing but these is gathered."""
    w = Window.partitionBy(rule).orderBy(key)
    first = found.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= most).groupBy(rule).agg(F.array_sort(F.collect_list(key)).alias("examples"))
    return found.groupBy(rule).agg(F.count("*").alias("n")).join(first, rule)
