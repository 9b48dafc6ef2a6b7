"""Run a registered query and its SQL counterpart and compare all rows."""

from __future__ import annotations

import datetime
import decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, folder, query, sql):
    """(number of rows, problem or None)"""
    df = query(spark, folder)
    columns, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected_columns, expected = rows_of(names, cursor.fetchall())
    if columns != expected_columns:
        return len(got), f"columns {columns} != {expected_columns}"
    if len(got) != len(expected):
        return len(got), f"{len(got)} rows != {len(expected)}"
    for mine, theirs in zip(got, expected):
        if mine != theirs or [type(a) for a in mine] != [type(b) for b in theirs]:
            return len(got), f"{mine} != {theirs}"
    return len(got), None
