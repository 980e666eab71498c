"""Comparison of a query's rows with its DuckDB equivalent."""

import decimal
import math
from pathlib import Path

import duckdb

SMALL = Path("/root/testdata/sf0.001")


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def rows(df):
    names = sorted(df.columns)
    return names, sorted(repr(tuple(plain(r[c]) for c in names)) for r in df.collect())


def oracle(sql, folder=SMALL):
    con = duckdb.connect()
    for f in folder.glob("*.parquet"):
        con.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    found = con.sql(sql)
    names = sorted(found.columns)
    at = [found.columns.index(c) for c in names]
    return names, sorted(repr(tuple(plain(r[k]) for k in at)) for r in found.fetchall())
