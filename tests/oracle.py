"""Compare a Spark result with DuckDB SQL over the same parquet tables.

Order-insensitive: columns are sorted by name, rows are compared as a
multiset of normalised tuples.
"""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return round(v, 9)
    return v


def _canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> tuple[bool, str]:
    s_cols, s_rows = _canon(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    d_cols, d_rows = _canon([c[0] for c in cur.description], cur.fetchall())
    if s_cols != d_cols:
        return False, f"columns differ: spark={s_cols} duckdb={d_cols}"
    ns, nd = sum(s_rows.values()), sum(d_rows.values())
    if s_rows != d_rows:
        only_s = list((s_rows - d_rows).items())[:3]
        only_d = list((d_rows - s_rows).items())[:3]
        return False, f"rows differ: spark={ns} duckdb={nd}; spark-only={only_s}; duckdb-only={only_d}"
    return True, f"{ns} rows"
