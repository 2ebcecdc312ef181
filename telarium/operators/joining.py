"""Joins that no single key can overload."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key counts as hot beyond this share of the rows; so there are at most 1 / HOT of them, which bounds what is broadcast.
HOT = 1 / 2000
#: No key is hot below so many rows.
LEAST = 1000


def lookup(rows: DataFrame, values: DataFrame, keys: list[str], n: str, total: int) -> DataFrame:
    """rows joined to values, which have each key once; column n says how many of the ``total`` rows have it, and is left out.

    Rows of hot keys meet their value in a broadcast and are taken away from the shuffled side before its shuffle. Rows without
    a value and null keys have no result. values are read several times, so they should be a settled table.
    """
    limit = max(LEAST, int(total * HOT))
    hot, cold = values.where(F.col(n) > limit).drop(n), values.where(F.col(n) <= limit).drop(n)
    if hot.isEmpty():
        return rows.join(cold, keys)
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return rest.join(cold, keys).unionByName(rows.join(F.broadcast(hot), keys))
