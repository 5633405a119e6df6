"""Connected components of a graph of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegraph.session import checked, materialize

#: Links that Spark may broadcast if their files are small.
MAX_BROADCAST = 500_000


def _ordered(edges: DataFrame) -> DataFrame:
    """Each link once, the larger end first."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(edges: DataFrame, few: bool) -> DataFrame:
    """Larger neighbours of a node are tied to the node's smallest neighbour."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    to_larger = edges.select(F.col("b").alias("node"), F.col("a").alias("far"))
    least = least if few else checked(least)
    tied = to_larger.join(least, to_larger["node"] == least["a"])
    return _ordered(tied.select(F.col("far").alias("a"), F.least("node", "least").alias("b")))


def _small_star(edges: DataFrame, few: bool) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    tied = edges.join(least if few else checked(least), "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return _ordered(tied.union(least.select("a", F.col("least").alias("b"))))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, root`` for every node of a link ``a, b`` between integers; the root is the component's smallest node.

    Every round is written to the shared folder. Self links count as no link; repeated links count once.
    """

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    current = materialize(_ordered(edges), "links")
    state = mark(current)
    for _ in range(max_rounds):
        if not state[0]:
            break
        few = state[0] <= MAX_BROADCAST
        current = materialize(_small_star(_large_star(current, few), few), "links")
        before, state = state, mark(current)
        if state == before:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = current.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
