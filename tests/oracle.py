"""Comparison of query results with SQL run in DuckDB."""

from __future__ import annotations

import datetime
import decimal
import math
from pathlib import Path

import duckdb
import numpy as np


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET threads = 2")
    for f in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS FROM '{f}'")
    return con


def plain(v):
    """A value that is the same from either engine; floats to nine places."""
    if isinstance(v, (float, np.floating)):
        return None if math.isnan(v) else ("f", round(float(v), 9))
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(plain(x) for x in v)
    if isinstance(v, decimal.Decimal):
        return ("d", str(v.normalize()))
    if isinstance(v, np.integer):
        return int(v)
    if isinstance(v, datetime.datetime):
        return ("t", v.replace(tzinfo=None).isoformat())
    return v


def rows(columns: list[str], data) -> list[str]:
    at = [columns.index(c) for c in sorted(columns)]
    return sorted(repr(tuple(plain(r[i]) for i in at)) for r in data)


def assert_same(df, con, sql: str) -> None:
    ours = df.collect()
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    a, b = rows(df.columns, ours), rows(names, result.fetchall())
    assert len(a) == len(b)
    assert a == b
