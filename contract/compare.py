"""Compare a Spark result with DuckDB's, row by row without regard to order."""

from __future__ import annotations

import glob
import os
from collections import Counter
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    """In-process DuckDB with every table of the folder as a view."""
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _value(cell: object) -> object:
    if isinstance(cell, Decimal):
        raise TypeError("money must be handed out as a double")
    return repr(cell)


def _rows(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def differences(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between the two results; empty when they are equal."""
    answer = connection.execute(sql)
    expected_columns = [column[0] for column in answer.description]
    expected = _rows(expected_columns, answer.fetchall())
    found = _rows(result.columns, [tuple(row) for row in result.collect()])
    if sorted(result.columns) != sorted(expected_columns):
        return [f"columns {sorted(result.columns)} instead of {sorted(expected_columns)}"]
    missing, extra = expected - found, found - expected
    notes = [f"missing {row}" for row in list(missing)[:3]]
    notes += [f"unexpected {row}" for row in list(extra)[:3]]
    if notes:
        notes.append(f"{missing.total()} missing, {extra.total()} unexpected")
    return notes
