"""Comparison of a query with its SQL counterpart in DuckDB, value by value."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _kind(value) -> str:
    if isinstance(value, bool):
        return "bool"
    return type(value).__name__


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shaped = [tuple(r[i] for i in order) for r in rows]
    return [columns[i] for i in order], sorted(shaped, key=lambda r: tuple((v is None, str(v)) for v in r))


def difference(df, con, sql: str) -> str | None:
    """None if both sides agree in columns, types and rows; otherwise what differs first."""
    got_columns, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    want_columns, want = _rows([d[0] for d in result.description], result.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)} rows; e.g. {got[:2]} vs {want[:2]}"[:2000]
    if not got:
        return "no rows on either side"
    for a, b in zip(got, want):
        if a != b:
            return f"{got_columns}: {a} != {b}"[:2000]
        for x, y in zip(a, b):
            if _kind(x) != _kind(y) or isinstance(x, (decimal.Decimal, dt.datetime)):
                return f"{got_columns}: type {_kind(x)} / {_kind(y)} in {a}"
    return None
