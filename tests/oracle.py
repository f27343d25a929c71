"""Compare a registered query with its SQL run by DuckDB on the same files."""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, (float, Decimal)):
        number = float(value)
        return "nan" if math.isnan(number) else (number + 0.0 if number else 0.0)
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return value


def sorted_rows(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    lines = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(lines, key=lambda line: tuple((v is not None, str(type(v)), v) if v is not None else (False, "", 0) for v in line))


def difference(frame, connection, sql: str) -> str | None:
    """None when both agree, else what differs."""
    rows = frame.collect()
    found = connection.execute(sql)
    names = [d[0] for d in found.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(names)}"
    ours = sorted_rows(rows, frame.columns)
    theirs = sorted_rows(found.fetchall(), names)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(wrong)} of {len(ours)} rows differ, first {wrong[0]}" if wrong else None
