"""Aggregates per case. Each one combines on the map side, so a case with very many
rows reaches the reducer as one row per map task (or one per distinct item)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_per_key(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


#: Registers of a sketch, as a power of two: a relative standard error of about 1.6 %.
SKETCH_BITS = 12


def distinct_sketches(df: DataFrame, keys: Sequence[str], column: str, bits: int = SKETCH_BITS) -> DataFrame:
    """``keys, sketch``: what is needed to estimate the distinct non-null values per key, a few kilobytes at most. Sketches of
    later increments can be added with ``merged_sketches``, without the rows they were made of."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(F.col(column).cast("string"), bits).alias("sketch"))


def merged_sketches(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One sketch per key, of all values of its sketches."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimated_distinct(sketches: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    return sketches.select(*keys, F.hll_sketch_estimate("sketch").alias(name))


def distinct_per_key(df: DataFrame, keys: Sequence[str], column: str, name: str = "n", approx: bool = False) -> DataFrame:
    """Number of distinct non-null values per key; first the distinct pairs, then their count.

    ``approx`` estimates it from sketches, which are combined before the shuffle, so that a key with very many
    different values reaches the reducer as a sketch per map task.
    """
    if approx:
        return estimated_distinct(distinct_sketches(df, keys, column), keys, name)
    pairs = df.select(*keys, column).distinct()
    return pairs.groupBy(*keys).agg(F.count(column).alias(name))


def mean_per_key(df: DataFrame, keys: Sequence[str], column: str, name: str = "mean") -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(column).alias(name))


def profile_per_key(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Mean and sample standard deviation (null for a single value)."""
    return df.groupBy(*keys).agg(
        F.avg(column).alias("mean_value"),
        F.stddev_samp(column).alias("std_value"),
    )


def items_and_mean(df: DataFrame, key: str, item: str, value: str, items_name: str, mean_name: str) -> DataFrame:
    """Distinct items and overall mean per key from one pass.

    Rows are first summed per (key, item); the second step only adds up those sums, so
    the mean over rows stays exact and no distinct expansion is needed.
    """
    per_item = df.groupBy(key, item).agg(F.sum(value).alias("_sum"), F.count(value).alias("_n"))
    return per_item.groupBy(key).agg(
        F.count(item).alias(items_name),
        (F.sum("_sum") / F.nullif(F.sum("_n"), F.lit(0))).alias(mean_name),
    )


def set_per_key(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    """Sorted set of the non-null values per key."""
    return df.groupBy(*keys).agg(F.array_sort(F.collect_set(column)).alias(name))


def group_counts(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    return count_per_key(df, [column], name)
