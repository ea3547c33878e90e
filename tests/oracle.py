"""Run a query and its SQL and compare the rows, order aside."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb
import pandas as pd

ALL = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in ALL:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    if isinstance(v, float):
        return float(f"{v:.12g}")
    if isinstance(v, decimal.Decimal):
        return ("d", str(v))
    return v


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    out = [tuple(_cell(r[k]) for k in order) for r in rows]
    return sorted(out, key=repr)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, else what differs."""
    got = rows_of(df.columns, df.collect())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = rows_of(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want, strict=True) if g != w]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None
