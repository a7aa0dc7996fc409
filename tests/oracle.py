"""Comparing a Spark query with its DuckDB equivalent."""

from __future__ import annotations

import datetime
import math
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return repr(value)


def _canonical(names: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark_frame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when names, types, row count and values agree."""
    result = connection.execute(sql)
    sql_names = [d[0] for d in result.description]
    sql_types = dict(zip(sql_names, [str(d[1]) for d in result.description]))
    expected_names, expected = _canonical(sql_names, result.fetchall())
    names, found = _canonical(spark_frame.columns, [tuple(r) for r in spark_frame.collect()])
    problems = []
    if names != expected_names:
        return [f"columns {names} != {expected_names}"]
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    for name, dtype in spark_frame.dtypes:
        if same.get(dtype) != sql_types[name] and not (dtype == "timestamp" and "TIMESTAMP" in sql_types[name]):
            problems.append(f"{name}: {dtype} != {sql_types[name]}")
    if len(found) != len(expected):
        problems.append(f"{len(found)} rows != {len(expected)}")
    gaps = [(a, b) for a, b in zip(found, expected) if a != b]
    if gaps:
        problems.append(f"{len(gaps)} rows differ, first: {gaps[0]}")
    return problems
