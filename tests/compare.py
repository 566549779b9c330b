"""Row-multiset comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import collections
import datetime as dt
import decimal
import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f'CREATE VIEW "{name}" AS SELECT * FROM \'{path}\'')
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, float) and value == 0:
        return repr(value)
    return value


def rows_of(names, rows) -> collections.Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return collections.Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, sql: str, con) -> str | None:
    cursor = con.execute(sql)
    expected_names = [d[0] for d in cursor.description]
    expected = rows_of(expected_names, cursor.fetchall())
    if sorted(df.columns) != sorted(expected_names):
        return f"columns {sorted(df.columns)} != {sorted(expected_names)}"
    actual = rows_of(df.columns, [tuple(row) for row in df.collect()])
    if actual == expected:
        return None
    extra, missing = actual - expected, expected - actual
    return (
        f"{sum(actual.values())} rows against {sum(expected.values())}; "
        f"only Spark {list(extra)[:3]}; only SQL {list(missing)[:3]}"
    )
