"""Spark vs DuckDB comparison used by the oracle tests (order-insensitive)."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if hasattr(v, "isoformat"):
        return str(pd.Timestamp(v))
    if isinstance(v, bool):
        return int(v)
    return v


def rows_of(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = [tuple(_norm(r[c]) for c in cols) for r in df[cols].to_dict("records")]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def spark_rows(sdf) -> pd.DataFrame:
    return pd.DataFrame([r.asDict() for r in sdf.collect()], columns=sdf.columns)


def assert_same(sdf, con, sql: str, label: str = "") -> int:
    s = spark_rows(sdf)
    d = con.execute(sql).df()
    d = d.astype(object).where(pd.notna(d), None)
    assert sorted(s.columns) == sorted(d.columns), f"{label}: columns differ\n{sorted(s.columns)}\n{sorted(d.columns)}"
    rs, rd = rows_of(s), rows_of(d)
    assert len(rs) == len(rd), f"{label}: row count spark={len(rs)} duckdb={len(rd)}"
    for a, b in zip(rs, rd):
        assert a == b, f"{label}: first differing row\nspark ={a}\nduckdb={b}\ncols={sorted(s.columns)}"
    return len(rs)
