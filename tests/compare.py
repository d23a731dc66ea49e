"""Runs a query and its SQL over the same tables and compares the rows, whatever their order."""

from __future__ import annotations

import datetime
import decimal
import math
import os
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SF_DIR = os.environ.get("QUERN_SF_DIR", "/root/testdata/sf0.001")


def connect(sf_dir: str = SF_DIR) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = Path(sf_dir, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p}{'/*.parquet' if p.is_dir() else ''}'")
    return con


def plain(v):
    """A value as something that compares alike from either engine."""
    if v is None or isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v) or math.isinf(v):
            return str(v)
        v = float(f"{v:.9g}")
        return int(v) if v == int(v) else v
    if isinstance(v, int):
        return v
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if hasattr(v, "asDict"):
        v = v.asDict()
    if isinstance(v, dict):
        return tuple(sorted(((str(k), plain(x)) for k, x in v.items()), key=str))
    if isinstance(v, (list, tuple)) or hasattr(v, "tolist"):
        return tuple(plain(x) for x in v)
    return str(v)


def rows_of(columns: list[str], rows) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(str([plain(r[i]) for i in order]) for r in rows)


def difference(spark, query, sql: str, sf_dir: str = SF_DIR, con=None) -> str:
    """Empty if both have the same columns and rows."""
    df = query(spark, sf_dir)
    result = (con or connect(sf_dir)).execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    ours, theirs = rows_of(df.columns, df.collect()), rows_of(names, result.fetchall())
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}: {ours[:2]} {theirs[:2]}"
    for a, b in zip(ours, theirs, strict=True):
        if a != b:
            return f"{a[:600]}\nagainst\n{b[:600]}"
    return ""
