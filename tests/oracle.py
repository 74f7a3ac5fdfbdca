"""Runs a registered query and its reference SQL and compares the rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> dict:
    """Row counts, column names and the rows found on one side only."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = _rows(names, result.fetchall())
    got = _rows(df.columns, df.collect())
    return {
        "rows": (sum(got.values()), sum(want.values())),
        "columns": sorted(names) == sorted(df.columns),
        "extra": got - want,
        "lost": want - got,
    }
