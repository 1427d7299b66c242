"""Order-insensitive comparison of a Spark result with DuckDB's answer (tests and checks)."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return [_plain(item) for item in value]
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def spark_rows(df):
    return rows_of(df.columns, [tuple(row) for row in df.collect()])


def duck_rows(con, sql):
    cursor = con.execute(sql)
    columns = [item[0] for item in cursor.description]
    return rows_of(columns, cursor.fetchall())
