"""Runs a query in Spark and its oracle in DuckDB and compares the rows as multisets."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _kind(value) -> str:
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, int):
        return "int"
    if isinstance(value, float):
        return "float"
    if isinstance(value, decimal.Decimal):
        return "decimal"
    if isinstance(value, datetime.datetime):
        return "timestamp"
    if isinstance(value, datetime.date):
        return "date"
    return type(value).__name__


def _cell(value):
    if value is None:
        return None
    if isinstance(value, float) and math.isnan(value):
        return ("float", "nan")
    if isinstance(value, decimal.Decimal):
        value = value.normalize()
    return (_kind(value), value)


def _bag(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(df, connection, sql: str) -> str | None:
    """None when equal, else what differs first."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    expected = _bag(names, result.fetchall())
    actual = _bag(df.columns, [tuple(row) for row in df.collect()])
    if actual == expected:
        return None
    missing, extra = list((expected - actual).items()), list((actual - expected).items())
    return (
        f"{sum(actual.values())} rows, oracle {sum(expected.values())}; columns {sorted(names)}\n"
        f"only in oracle ({len(missing)}): {missing[:3]}\nonly in query ({len(extra)}): {extra[:3]}"
    )
