"""Order-insensitive comparison of a Spark result with a DuckDB oracle."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.10g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.10g}")
    if isinstance(v, dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def compare(df, con, sql: str) -> tuple[bool, str]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in df.collect()]
    rel = con.sql(sql)
    ocols = rel.columns
    if sorted(ocols) != cols:
        return False, f"columns differ: spark {cols} oracle {sorted(ocols)}"
    orows_raw = rel.fetchall()
    idx = [ocols.index(c) for c in cols]
    orows = [tuple(_norm(r[i]) for i in idx) for r in orows_raw]
    if len(rows) != len(orows):
        return False, f"row count spark {len(rows)} oracle {len(orows)}"
    a, b = Counter(rows), Counter(orows)
    if a != b:
        diff_a = list((a - b).elements())[:3]
        diff_b = list((b - a).elements())[:3]
        return False, f"values differ; spark-only {diff_a} oracle-only {diff_b}"
    return True, f"{len(rows)} rows"
