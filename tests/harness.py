"""Cross-engine comparison like the driver's: Spark query vs DuckDB oracle SQL."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

# LEDGERLOOM_EXACT_FLOATS=1 compares doubles bit for bit (no rounding)
EXACT_FLOATS = os.environ.get("LEDGERLOOM_EXACT_FLOATS") == "1"

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if EXACT_FLOATS else round(v, 9)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "cols_match": sorted(s_cols) == sorted(d_cols)}
    if not out["cols_match"]:
        out["spark_cols"], out["oracle_cols"] = sorted(s_cols), sorted(d_cols)
        out["match"] = False
        return out
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    d_index = {c: i for i, c in enumerate(d_cols)}
    s_norm = sorted((tuple(_norm(r[i]) for i in order) for r in s_rows), key=_key)
    d_norm = sorted((tuple(_norm(r[d_index[s_cols[i]]]) for i in order) for r in d_rows), key=_key)
    out["match"] = s_norm == d_norm
    if not out["match"]:
        cols = [s_cols[i] for i in order]
        sd, dd = set(s_norm), set(d_norm)
        only_s = [r for r in s_norm if r not in dd][:3]
        only_d = [r for r in d_norm if r not in sd][:3]
        out["cols"] = cols
        out["only_spark"] = only_s
        out["only_oracle"] = only_d
        if only_s and only_d:
            out["diff_cols"] = [c for c, a, b in zip(cols, only_s[0], only_d[0]) if a != b]
    return out
