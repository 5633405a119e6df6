"""Cohort selection, row filters and deduplication.

Wherever rows of a large table are kept or dropped by an id, that table is the left
side of the join and the ids are unique on the right, so that AQE can split a left
partition in which one id holds a large share of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casegraph.session import fits, materialize


def cohort_ids(evidence: DataFrame, key: str) -> DataFrame:
    """Distinct non-null ids of an evidence table such as the notes."""
    return evidence.where(F.col(key).isNotNull()).select(key).distinct()


def restrict(table: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``table`` whose ``key`` is in ``ids``."""
    return table.join(ids.select(key), key, "left_semi")


def restrict_wide(
    table: DataFrame, ids: DataFrame, key: str, by: str, how: str = "left_semi", parts: int = 16, max_broadcast_ids: int = 50_000
) -> DataFrame:
    """``restrict`` (or its complement, ``left_anti``) for rows that are costly to process afterwards, such as notes.

    The rows of one id are spread over ``parts`` groups by the content of column ``by``. A later
    aggregation by id then cannot inherit the partitioning of this join, which would leave
    all notes of one id to one task.
    """
    # only ids that the table has are multiplied; they are stored, as they are counted first
    known = ids.select(key).distinct().join(table.select(key).distinct(), key, "left_semi")
    known = materialize(known, "known-ids")
    copies = F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint"))
    spread = known.withColumn("_group", F.explode(copies))
    if not fits(known, max_broadcast_ids):
        # Spark takes the copies for as small as the ids, and would send them to every task by way of the driver
        spread = spread.hint("merge")
    grouped = table.withColumn("_group", F.pmod(F.xxhash64(by), F.lit(parts)))
    return grouped.join(spread, [key, "_group"], how).select(*table.columns)


def restrict_parents(parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """Rows of ``parents`` referenced by ``children`` (patients of the kept admissions)."""
    return restrict(parents, cohort_ids(children, key), key)


def excluded(table: DataFrame, ids: DataFrame, key: str, reason: str) -> DataFrame:
    """Rows that ``restrict`` leaves out, with the reason."""
    return table.join(ids.select(key), key, "left_anti").withColumn("reason", F.lit(reason))


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(columns))


def valid_interval(df: DataFrame, start: str, end: str) -> DataFrame:
    """Rows whose end is not before their start; a missing end does not qualify."""
    return df.where(F.col(end) >= F.col(start))


def at_least(df: DataFrame, column: str, minimum: float) -> DataFrame:
    return df.where(F.col(column) >= minimum)


def plausible(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Rows with a present value within the bounds, both included."""
    return df.where(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double")) & F.col(column).between(low, high))


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """One whole row per key: the first in a declared order, by default that of all other columns.

    The rank filter is pushed below the exchange (``WindowGroupLimit``), so a map task
    ships at most one row per key however many rows share it.
    """
    order = list(order_by or [])
    order += [F.col(c) for c in df.columns if c not in keys]
    if not order:
        return df.distinct()
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()
