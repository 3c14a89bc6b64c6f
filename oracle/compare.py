"""Run a query in Spark and its statement in DuckDB, and compare the rows."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, int):
        return float(value)
    return str(value)


def _counted(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(frame: DataFrame, connection, sql: str) -> list[str]:
    """What differs; an empty list means equal columns and equal rows."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(frame.columns):
        return [f"columns {sorted(frame.columns)} against {sorted(names)}"]
    expected = _counted(names, result.fetchall())
    actual = _counted(frame.columns, [tuple(r) for r in frame.collect()])
    if actual == expected:
        return []
    only_here, only_there = actual - expected, expected - actual
    return [
        f"rows {sum(actual.values())} against {sum(expected.values())}",
        f"only in Spark ({sum(only_here.values())}): {sorted(only_here, key=str)[:2]}",
        f"only in SQL ({sum(only_there.values())}): {sorted(only_there, key=str)[:2]}",
    ]
