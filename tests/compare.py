"""Run queries beside their SQL in DuckDB and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from '{path}'")
    return con


def norm(v):
    if v is None:
        return "~null"
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, decimal.Decimal)):
        return float(v) if abs(v) < 2**53 else str(int(v))
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.12g}")
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, (list, tuple)):
        return str([norm(x) for x in v])
    return str(v)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(norm(r[i])) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    want = rows_of(names, res.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    got = rows_of(df.columns, df.collect())
    if got == want:
        return None
    extra = [r for r in got if r not in set(want)][:2]
    missing = [r for r in want if r not in set(got)][:2]
    return f"{len(got)} rows, want {len(want)}; extra {str(extra)[:600]}; missing {str(missing)[:600]}"
