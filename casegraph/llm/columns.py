"""Columns of the input whose names an operator needs for itself."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def set_aside(df: DataFrame, names: Iterable[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with columns called like one of ``names`` under other names, and the way back to the columns of ``df``."""
    taken = {n.lower() for n in names}
    prefix = "_own_"
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix += "own_"
    moved = {c: prefix + c for c in df.columns if c.lower() in taken}
    columns = df.columns

    def restore(result: DataFrame) -> DataFrame:
        return result.select(*(F.col(moved.get(c, c)).alias(c) for c in columns))

    return df.withColumnsRenamed(moved), restore


def with_length(df: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """The column of text lengths, if there is one, made to fit the texts; null for a null text."""
    if length not in df.columns:
        return df
    return df.withColumn(length, F.char_length(text).cast(df.schema[length].dataType))
