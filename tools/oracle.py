"""Comparison of a registered query with its DuckDB oracle (used by tests and tools/oracle_check.py).

Rows are compared as an order-insensitive multiset over columns sorted by name; floats are
rounded to 6 places, dates rendered ISO.
"""

from __future__ import annotations

import datetime as dt
import math
import os

import duckdb

from inkstream.sources.tables import TABLES, table_path


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "tolist"):
        return norm(v.tolist())
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in records]
    return sorted(out, key=repr)


def duck_connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = table_path(sf_dir, t)
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(sdf, con, sql: str) -> tuple[bool, str]:
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    rel = con.execute(sql)
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    if sorted(scols) != sorted(dcols):
        return False, f"columns spark={scols} duck={dcols}"
    sr, dr = rows_of(scols, srows), rows_of(dcols, drows)
    if sr == dr:
        return True, f"{len(sr)} rows"
    dset, sset = set(dr), set(sr)
    only_s = [r for r in sr if r not in dset][:2]
    only_d = [r for r in dr if r not in sset][:2]
    return False, (f"rows spark={len(sr)} duck={len(dr)} cols={sorted(scols)}\n"
                   f"  spark-only: {repr(only_s)[:800]}\n  duck-only: {repr(only_d)[:800]}")
