"""Comparison of query results with the results of their SQL in DuckDB."""

from __future__ import annotations

import os
from decimal import Decimal

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(sf_dir, name)}.parquet'")
    return connection


def _cell(value):
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and value != value):
        return None
    if isinstance(value, pd.Timestamp):
        return value.tz_localize(None).isoformat()
    if isinstance(value, Decimal):
        return float(value)
    if hasattr(value, "item"):
        value = value.item()
    return value


def normalized(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = [tuple(_cell(v) for v in row) for row in frame.astype(object).itertuples(index=False, name=None)]
    return sorted(rows, key=lambda row: tuple((v is not None, str(type(v)), v) for v in row))


def difference(actual: pd.DataFrame, expected: pd.DataFrame) -> str | None:
    """None if both have the same columns and the same rows in any order."""
    if sorted(actual.columns) != sorted(expected.columns):
        return f"columns {sorted(actual.columns)} != {sorted(expected.columns)}"
    if len(actual) != len(expected):
        return f"{len(actual)} rows != {len(expected)}"
    left, right = normalized(actual), normalized(expected)
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None
