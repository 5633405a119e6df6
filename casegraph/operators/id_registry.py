"""Positions of keys that never change: an index that only grows.

``dense_index`` numbers what it is given, so positions move when keys are added. A registry keeps every position
once given; keys that a later batch brings get the following ones, in ascending order within the batch. Tensors,
embeddings and edges stored by position so stay valid over increments.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casegraph.operators.ranking import dense_index
from casegraph.sources.merged import MergedTable, manifest, merge_rows, read_merged, rows_near


def _registry(folder: str, key: str, buckets: int) -> MergedTable:
    if key.lower() in ("idx", "batch"):
        raise ValueError(f"a key cannot be named {key}")
    return MergedTable(folder, (key,), buckets=buckets)


def extend_index(keys: DataFrame, key: str, folder: str, buckets: int = 64) -> DataFrame | None:
    """Register the distinct non-null values of ``key`` and return the whole registry, as ``read_index`` does.

    Only buckets in which the batch has a key are read for the comparison. Repeating a batch changes nothing. Of two
    batches at a time one is an error and can be repeated, since both would give the same positions to different keys.
    None if there was never a key.
    """
    spark = keys.sparkSession
    table = _registry(folder, key, buckets)
    current = manifest(spark, table)
    new = keys.select(key).where(F.col(key).isNotNull())
    before, taken = 0, 0
    if current is not None:
        before = current.version
        new = new.select(F.col(key).cast(current.columns[key].dataType).alias(key)).where(F.col(key).isNotNull())
        taken = read_merged(spark, table).count()  # from the files' footers
        new = new.distinct()
        new = new.join(rows_near(spark, table, new).select(key), key, "left_anti")
    placed = dense_index(new, key)
    rows = placed.select(key, (F.col("idx") + taken).alias("idx"), F.lit(before + 1).alias("batch"))
    merge_rows(rows, table, version=before)
    return read_index(spark, key, folder)


def read_index(spark: SparkSession, key: str, folder: str) -> DataFrame | None:
    """``key``, ``idx`` (dense from 0) and ``batch`` (number of the extension that brought the key); None if there was none."""
    return read_merged(spark, _registry(folder, key, 1))
