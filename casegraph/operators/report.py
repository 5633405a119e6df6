"""Row counts before and after each step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def funnel(steps: Sequence[tuple[str, str, DataFrame, DataFrame]]) -> DataFrame:
    """(table, step, before, after, dropped) for (table, step, rows before, rows after) entries."""
    # The rows after a step are those before the next: every table is counted once.
    tables: dict[int, tuple[DataFrame, list]] = {}
    for table, step, before, after in steps:
        for side, rows in (("before", before), ("after", after)):
            use = F.struct(F.lit(table).alias("table"), F.lit(step).alias("step"), F.lit(side).alias("side"))
            tables.setdefault(id(rows), (rows, []))[1].append(use)
    parts = [rows.agg(F.count(F.lit(1)).alias("n")).select(F.inline(F.array(*uses)), "n") for rows, uses in tables.values()]
    counts = parts[0]
    for part in parts[1:]:
        counts = counts.unionByName(part)
    sides = counts.groupBy("table", "step").agg(
        F.sum(F.when(F.col("side") == "before", F.col("n"))).alias("before"),
        F.sum(F.when(F.col("side") == "after", F.col("n"))).alias("after"),
    )
    return sides.withColumn("dropped", F.col("before") - F.col("after"))


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` with a row counter that is filled by the first action on it, at no extra pass.

    A filter behind it is not pushed below it, so use it where the count is wanted anyway.
    """
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation
