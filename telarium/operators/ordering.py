"""Operators that depend on an order: positions, suffixes, carried labels, bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def position_in_group(df: DataFrame, group: list[str], order: list[str], name: str = "position") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))


def unique_ids(df: DataFrame, key: str, order: list[str], name: str = "unique_id") -> DataFrame:
    """The n-th repeat of an id in order gets the suffix __n; null stays null."""
    n = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn(name, F.when(n > 1, F.concat_ws("__", F.col(key), n)).otherwise(F.col(key)))


def carry_forward(df: DataFrame, group: list[str], order: list[str], label: Column, name: str = "label") -> DataFrame:
    """The last label so far."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.last(label, ignorenulls=True).over(w))


def regroup(df: DataFrame, group: list[str], order: list[str], opens: Column, text: str) -> DataFrame:
    """Rows between two openings put together: (group, nr, n, text), text joined by spaces in order."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = df.withColumn("_nr", F.sum(opens.cast("int")).over(w))
    parts = F.array_sort(F.collect_list(F.struct(*order, F.col(text).alias("_t"))))
    return x.groupBy(*group, F.col("_nr").alias("nr")).agg(F.count("*").alias("n"), F.array_join(F.transform(parts, lambda p: p["_t"]), " ").alias("text"))


def assign_bands(items: DataFrame, marks: DataFrame, group: list[str], y: str, mark: str, tolerance: float) -> DataFrame:
    """As-of join: each item belongs to the last mark of its group at most ``tolerance`` below it, null if there is none.

    One sort of the union of both sides; no range join.
    """
    cols = items.columns
    a = marks.select(*group, F.col(y).cast("double").alias("_y"), F.lit(0).alias("_side"), F.col(mark).alias("_mark"), *[F.lit(None).cast(items.schema[c].dataType).alias(f"_i_{c}") for c in cols])
    b = items.select(*group, (F.col(y).cast("double") + tolerance).alias("_y"), F.lit(1).alias("_side"), F.lit(None).cast(marks.schema[mark].dataType).alias("_mark"), *[F.col(c).alias(f"_i_{c}") for c in cols])
    w = Window.partitionBy(*group).orderBy("_y", "_side", "_mark").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = a.unionByName(b).withColumn("_m", F.last("_mark", ignorenulls=True).over(w)).where("_side = 1")
    return out.select(*[F.col(f"_i_{c}").alias(c) for c in cols], F.col("_m").alias(mark))


def upper_median(df: DataFrame, group: list[str], value: str, name: str = "median") -> DataFrame:
    """The middle value of a group, the upper of the two middle ones. Equal values are counted within tasks first, so only different ones are sorted."""
    w = Window.partitionBy(*group)
    c = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("_c"))
    r = c.select(*group, value, "_c", F.sum("_c").over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_to"), F.sum("_c").over(w).alias("_n"))
    return r.where("_to - _c < floor(_n / 2) + 1 AND floor(_n / 2) + 1 <= _to").select(*group, F.col(value).alias(name))
