"""Compare registered queries with their SQL in DuckDB, order-insensitively."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return value


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))


def differences(spark_frame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, else what differs first."""
    cursor = con.execute(sql)
    wanted_columns = [d[0] for d in cursor.description]
    wanted = _rows(wanted_columns, cursor.fetchall())
    columns = spark_frame.columns
    if sorted(columns) != sorted(wanted_columns):
        return f"columns {sorted(columns)} != {sorted(wanted_columns)}"
    found = _rows(columns, spark_frame.collect())
    if len(found) != len(wanted):
        return f"{len(found)} rows, expected {len(wanted)}"
    for a, b in zip(found, wanted):
        if a != b:
            return f"{a} != {b}"
    return None
