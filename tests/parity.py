"""Spark vs DuckDB comparison used by the tests (same rule as the driver:
row count, column names, order-insensitive values)."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, 9)
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__), str(x)) for x in row)


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    cols = sorted(spark_df.columns)
    srows = [tuple(_norm(r[c]) for c in cols) for r in spark_df.collect()]
    rel = con.sql(sql)
    dcols = rel.columns
    if sorted(dcols) != cols:
        return False, f"columns differ: spark={cols} duck={sorted(dcols)}"
    idx = [dcols.index(c) for c in cols]
    drows = [tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()]
    if len(srows) != len(drows):
        return False, f"row count spark={len(srows)} duck={len(drows)}"
    srows.sort(key=_key)
    drows.sort(key=_key)
    for a, b in zip(srows, drows):
        if a != b:
            return False, f"first diff:\n spark={a}\n duck ={b}"
    return True, f"{len(srows)} rows equal"
