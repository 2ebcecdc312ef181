"""Compares a query with its SQL on the same tables."""

import os

import pandas as pd

DATA = os.environ.get("TELARIUM_TESTDATA", "/root/testdata/sf0.001")


def connect():
    import duckdb

    con = duckdb.connect()
    for f in sorted(os.listdir(DATA)):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    return con


def _value(v):
    if v is None or not isinstance(v, (list, dict)) and pd.isna(v) is True:
        return None
    v = v.item() if hasattr(v, "item") else v
    return int(v) if isinstance(v, float) and v == int(v) else v


def rows(df: pd.DataFrame) -> list[str]:
    return sorted(repr([_value(v) for v in r]) for r in df[sorted(df.columns)].astype(object).values.tolist())


def agree(spark, con, query, sql: str) -> None:
    got, want = query(spark, DATA).toPandas(), con.sql(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
