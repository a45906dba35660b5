"""Runs a query in Spark and its SQL in DuckDB, and compares rows without order."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.10g}")
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def differences(spark, query, sql: str, sf_dir: str) -> str:
    """Empty if alike, else what differs."""
    got = query(spark, sf_dir)
    cursor = duck(sf_dir).execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(got.columns):
        return f"columns {sorted(got.columns)} != {sorted(names)}"
    order = sorted(names)
    a = Counter(tuple(plain(r[c]) for c in order) for r in got.collect())
    at = [names.index(c) for c in order]
    b = Counter(tuple(plain(r[k]) for k in at) for r in cursor.fetchall())
    return "" if a == b else f"{sum(a.values())} and {sum(b.values())} rows; only Spark {list((a - b).items())[:3]}; only SQL {list((b - a).items())[:3]}"
