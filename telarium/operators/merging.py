"""Merges, preferences and comparisons of two tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best_by_rank(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row for each key, the first in order."""
    return df.withColumn("_k", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("_k = 1").drop("_k")


def insert_with_preference(df: DataFrame, key: list[str], has: Column, order: list[str], qualifier: str) -> DataFrame:
    """Two routes to one key: outcome new, kept, folded or qualified.

    The first row of a key is compared with the later ones: a row with content takes the place of one without, which is
    folded into it; where both have content or neither has, the later is kept under key__qualifier.
    """
    w = Window.partitionBy(*key).orderBy(*order)
    x = df.withColumn("_has", has).withColumn("_n", F.row_number().over(w)).withColumn("_first", F.first("_has").over(w)).withColumn("_fill", F.row_number().over(Window.partitionBy(*key, "_has").orderBy(*order)))
    any_has = F.max(F.col("_has").cast("int")).over(Window.partitionBy(*key)) == 1
    x = x.withColumn("_any", any_has)
    outcome = (
        F.when(F.col("_n") == 1, F.when(F.col("_has") | ~F.col("_any"), "new").otherwise("folded"))
        .when(F.col("_has"), F.when((F.col("_fill") == 1) & ~F.col("_first"), "kept").otherwise("qualified"))
        .otherwise(F.when(F.col("_any"), "folded").otherwise("qualified"))
    )
    name = F.when(outcome == "qualified", F.concat_ws("__", F.col(key[-1]), F.col(qualifier))).otherwise(F.col(key[-1]))
    return x.withColumn("outcome", outcome).withColumn("stored_as", name).drop("_has", "_n", "_first", "_fill", "_any")


def coverage(expected: DataFrame, held: DataFrame, key: list[str]) -> DataFrame:
    """Every expected key with its status, and every other key that is held: ingested, empty, missing or unexpected.

    held(key..., n): rows that are there. One full outer join.
    """
    e = expected.select(*key).distinct().withColumn("_e", F.lit(True))
    h = held.select(*key, F.col("n").alias("_n"))
    status = F.when(F.col("_e").isNull(), "unexpected").when(F.col("_n").isNull(), "missing").when(F.col("_n") > 0, "ingested").otherwise("empty")
    return e.join(h, key, "full_outer").select(*key, F.coalesce("_n", F.lit(0)).cast("long").alias("n"), status.alias("status"))


def differences(stored: DataFrame, live: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field, kind): missing, extra or differs; null and empty values are equal. Null keys are left out."""
    v = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    a = stored.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.lit(True).alias("_s"), *[v(F.col(f)).alias(f"s_{f}") for f in fields])
    b = live.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.lit(True).alias("_l"), *[v(F.col(f)).alias(f"l_{f}") for f in fields])
    both = a.join(b, "key", "full_outer")
    kinds = F.when(F.col("_s").isNull(), F.array(F.struct(F.lit("*").alias("field"), F.lit("missing").alias("kind")))).when(F.col("_l").isNull(), F.array(F.struct(F.lit("*").alias("field"), F.lit("extra").alias("kind")))).otherwise(
        F.array_compact(F.array(*[F.when(F.col(f"s_{f}") != F.col(f"l_{f}"), F.struct(F.lit(f).alias("field"), F.lit("differs").alias("kind"))) for f in fields])))
    return both.select("key", F.explode(kinds).alias("d")).select("key", "d.field", "d.kind")


def insert_absent(base: DataFrame, extra: DataFrame, key: list[str]) -> DataFrame:
    """base and the rows of extra whose key base doesn't have."""
    return base.unionByName(extra.join(base.select(*key).distinct(), key, "left_anti"), allowMissingColumns=True)


def compare_and_set(df: DataFrame, corrections: DataFrame, key: list[str], field: str) -> DataFrame:
    """df with ``field`` corrected, and correction_status: applied, already applied, skipped (another value stands there) or null.

    corrections(key..., original_value, corrected_value), one for each key.
    """
    c = corrections.select(*key, F.col("original_value").alias("_o"), F.col("corrected_value").alias("_c"))
    x = df.join(c, key, "left")
    status = F.when(F.col("_c").isNull(), F.lit(None)).when(F.col(field).eqNullSafe(F.col("_c")), "already applied").when(F.col(field).eqNullSafe(F.col("_o")), "applied").otherwise("skipped")
    return x.withColumn("correction_status", status).withColumn(field, F.when(F.col("correction_status") == "applied", F.col("_c")).otherwise(F.col(field))).drop("_o", "_c")


def fill_missing(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Columns filled only where they are null."""
    return df.withColumns({k: F.coalesce(F.col(k), v) for k, v in values.items()})
