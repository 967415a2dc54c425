"""Runs SQL of the same result in DuckDB and compares rows in any order."""

import glob
import math
import os
from collections import Counter
from decimal import Decimal

import duckdb


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (int, float, Decimal)):
        v = float(v)
        return None if math.isnan(v) else v + 0.0
    return v


def same(df, sql, folder):
    con = duckdb.connect()
    for f in glob.glob(f"{folder}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    found = con.sql(sql)
    columns = sorted(df.columns)
    assert columns == sorted(found.columns)
    at = [found.columns.index(c) for c in columns]
    want = Counter(tuple(plain(r[i]) for i in at) for r in found.fetchall())
    got = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    assert got == want, (list((got - want).items())[:3], list((want - got).items())[:3])
