"""Registration of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from workload.tables import Tables

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


def q(value: Column, digits: int = 4) -> Column:
    """Round so that two engines with different summation order agree (see ``q_sql``)."""
    scale = float(10**digits)
    return F.floor(value * scale + 0.5003) / scale


def q_sql(expression: str, digits: int = 4) -> str:
    scale = f"{10**digits}.0::DOUBLE"
    return f"floor(({expression}) * {scale} + 0.5003::DOUBLE) / {scale}"


def joined(items: Column) -> Column:
    """A list as text, so that any engine compares it the same way."""
    return F.array_join(items, "|")
