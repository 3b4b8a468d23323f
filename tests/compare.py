"""Compares a query's rows with its oracle's, column by column and value by value."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _kind(value):
    if isinstance(value, bool):
        return bool
    if isinstance(value, int):
        return int
    if isinstance(value, (float, Decimal)):
        return type(value)
    if isinstance(value, dt.datetime):
        return dt.datetime
    return type(value)


def _sortable(row):
    return tuple((v is not None, str(_kind(v)), v if not isinstance(v, float) or not math.isnan(v) else 0) for v in row)


def rows_of(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(r[i] for i in order) for r in data), key=_sortable)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def oracle_rows(con, sql):
    result = con.execute(sql)
    return rows_of([c[0] for c in result.description], result.fetchall())


def difference(got, want) -> str | None:
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows, oracle has {len(want[1])}"
    for a, b in zip(got[1], want[1]):
        if a != b or [_kind(x) for x in a] != [_kind(x) for x in b]:
            return f"first difference ({got[0]}):\n  spark  {a}\n  oracle {b}"
    return None
