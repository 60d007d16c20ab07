"""Spark-vs-DuckDB comparison used by the oracle tests.

Row count, column names and an order-insensitive, exact value comparison
(NaN equals NaN, -0.0 equals 0.0).
"""

from __future__ import annotations

import math

import duckdb
import pandas as pd

from riskfeat.sources.fixtures import BASE_TABLES


def duck_connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return ("null",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        if v == 0.0:
            return ("num", 0.0)
        return ("num", float(v))
    if isinstance(v, bool):
        return ("num", float(int(v)))
    if isinstance(v, int):
        return ("num", float(v))
    if isinstance(v, pd.Timestamp):
        return ("ts", v.to_pydatetime().replace(tzinfo=None).isoformat())
    if hasattr(v, "isoformat"):
        return ("ts", v.isoformat())
    if hasattr(v, "tolist"):
        return ("arr", tuple(_norm(x) for x in v.tolist()))
    if isinstance(v, (list, tuple)):
        return ("arr", tuple(_norm(x) for x in v))
    try:
        import decimal

        if isinstance(v, decimal.Decimal):
            return ("num", float(v))
    except Exception:
        pass
    return ("str", str(v))


def _rows(records: list[tuple]) -> list[tuple]:
    return sorted((tuple(_norm(v) for v in r) for r in records), key=repr)


def compare(spark_df, duck_sql: str, con: duckdb.DuckDBPyConnection) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.execute(duck_sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows)}
    if sorted(s_cols) != sorted(d_cols):
        out["ok"] = False
        out["cols"] = (sorted(set(s_cols) - set(d_cols)), sorted(set(d_cols) - set(s_cols)))
        return out
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    a = _rows([tuple(r[i] for i in si) for r in s_rows])
    b = _rows([tuple(r[i] for i in di) for r in d_rows])
    out["ok"] = a == b
    if not out["ok"] and len(a) == len(b):
        bad = {}
        for ra, rb in zip(a, b):
            for c, va, vb in zip(order, ra, rb):
                if va != vb:
                    bad.setdefault(c, (va, vb))
        out["first_diffs"] = dict(list(bad.items())[:8])
    return out
