"""Table, entity, report and per-case result sinks."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegraph.session import drop_table, materialize
from casegraph.sources.merged import MergedTable, lookup, merge_rows, read_merged


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    if fmt not in ("parquet", "csv", "json"):
        raise ValueError("fmt must be parquet, csv or json")
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        as_is = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        writer = writer.options(header=True, escape='"', **as_is)
    writer.format(fmt).save(path)


def write_entities(entities: DataFrame, path: str) -> None:
    """One JSON line per case: id and its three mention lists."""
    entities.write.mode("overwrite").json(path)


def write_report(report: DataFrame, path: str) -> None:
    """A report has a handful of rows, so it goes to one file."""
    report.coalesce(1).write.mode("overwrite").json(path)


def write_case_results(
    results: DataFrame, path: str, id_col: str = "hadm_id", buckets: int = 64, files_per_bucket: int = 4
) -> None:
    """Result documents of many cases, one folder per id bucket so that one case is found without a full scan.

    A bucket has at most ``files_per_bucket`` files; raise ``buckets`` with the number of cases.
    """
    bucketed = results.withColumn("bucket", F.pmod(F.xxhash64(id_col), F.lit(buckets)).cast("int"))
    part = F.pmod(F.hash(id_col), F.lit(files_per_bucket))
    bucketed.repartition("bucket", part).write.mode("overwrite").partitionBy("bucket").json(path)


def read_case_result(spark, path: str, case_id: int, id_col: str = "hadm_id", buckets: int = 64) -> DataFrame:
    """Results of one case; only its bucket is read, also to find the schema."""
    bucket = F.pmod(F.xxhash64(F.lit(case_id).cast("bigint")), F.lit(buckets)).cast("int")
    number = spark.range(1).select(bucket.alias("bucket")).first()["bucket"]
    return spark.read.json(f"{path}/bucket={number}").where(F.col(id_col) == case_id)


def merge_case_results(results: DataFrame, path: str, id_col: str = "hadm_id", rows_per_bucket: int = 100_000) -> None:
    """Add the results of a batch of cases to a Parquet table made for lookups; a case that comes again gets its new result.

    The first batch fixes the columns and, by its number of rows, the number of buckets. Later batches rewrite only
    buckets in which they have a case. Results without an id are left out; of several of one case any one counts.
    """
    # counted and merged: made once
    rows = materialize(results, "case-results")
    others = tuple(c for c in results.columns if c != id_col)
    merge_rows(rows, MergedTable(path, (id_col,), others, max(1, math.ceil(rows.count() / rows_per_bucket))))
    drop_table(rows)


def read_cases(spark, path: str, ids: list | None = None, id_col: str = "hadm_id") -> DataFrame | None:
    """Results of the cases ``ids``, of which only the buckets are opened, or of all cases; None if none were merged."""
    table = MergedTable(path, (id_col,))
    return read_merged(spark, table) if ids is None else lookup(spark, table, [(i,) for i in ids])
