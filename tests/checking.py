"""Compare a Spark result with the checking SQL: rows, column names and values."""

from __future__ import annotations

import datetime
import decimal
from collections import Counter
from glob import glob
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob(f"{folder}/*.parquet"):
        connection.execute(f"CREATE VIEW {Path(path).stem} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return ("dec", str(value))
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, datetime.date):
        return ("day", value.isoformat())
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark_df, connection, sql: str) -> list[str]:
    """Differences found (empty when equal)."""
    result = connection.execute(sql)
    expected_columns = [c[0] for c in result.description]
    expected = _bag(expected_columns, result.fetchall())
    got = _bag(spark_df.columns, spark_df.collect())
    problems = []
    if sorted(spark_df.columns) != sorted(expected_columns):
        problems.append(f"columns {sorted(set(spark_df.columns) ^ set(expected_columns))}")
    if sum(got.values()) != sum(expected.values()):
        problems.append(f"rows {sum(got.values())} != {sum(expected.values())}")
    if got != expected:
        only, missing = list((got - expected).items())[:1], list((expected - got).items())[:1]
        names = sorted(spark_df.columns)
        detail = ""
        if only and missing and not problems:
            detail = str([(n, a, b) for n, a, b in zip(names, only[0][0], missing[0][0]) if a != b][:6])
        problems.append(f"values differ in {sum((got - expected).values())} rows {detail}")
    return problems
