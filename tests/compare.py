"""Rows of a Spark query against the rows of its SQL."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
from decimal import Decimal

import duckdb


def database(folder: str):
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shaped = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(shaped, key=repr)


def spark_rows(frame):
    return normal(frame.columns, [tuple(r) for r in frame.collect()])


def sql_rows(connection, sql):
    cursor = connection.execute(sql)
    return normal([d[0] for d in cursor.description], cursor.fetchall())


def difference(frame, connection, sql):
    """None when both sides hold the same rows, else a short account."""
    got_columns, got = spark_rows(frame)
    want_columns, want = sql_rows(connection, sql)
    if got_columns != want_columns:
        return f"columns {got_columns} instead of {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows instead of {len(want)}; first {got[:2]} / {want[:2]}"
    for a, b in zip(got, want):
        if a != b:
            return f"{a} instead of {b}"
    return None
