"""Tables that grow by merging: rows of new keys are added, rows of known keys keep what was written first.

A table is a folder of buckets by key hash. A merge reads and rewrites only the buckets in which the delta has a key,
into files of their own, and publishes them by a manifest that names the current files of every bucket. Readers follow
the newest manifest, so they never see half a merge; a merge that fails before its manifest leaves the table as it was;
of two merges at a time only one can publish, the other is an error. ``vacuum`` deletes files that no manifest names.

* columns in ``overwrite`` take the delta's values on known keys; all others keep the first writer's, null or not;
* several delta rows of one key: the first in ``order`` counts;
* delta rows with a null key are left out; a delta without rows publishes nothing; merging a delta again changes nothing;
* a delta must have the table's columns; their names are free;
* files are sorted by key, so that ``lookup`` reads few row groups of the buckets it opens.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from casegraph.session import drop_table, materialize


@dataclass(frozen=True)
class MergedTable:
    folder: str
    keys: tuple[str, ...]
    overwrite: tuple[str, ...] = ()
    #: Chosen once, so that a bucket at its final size suits a task; kept in the manifest.
    buckets: int = 64


@dataclass(frozen=True)
class Manifest:
    version: int
    columns: StructType
    files: dict[int, str]  # bucket -> folder below ``data``
    buckets: int


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def manifest(spark: SparkSession, table: MergedTable) -> Manifest | None:
    """The newest one; None before the first merge."""
    files, folder = _files(spark, f"{table.folder}/manifests")
    if not files.exists(folder):
        return None
    names = sorted(n for n in (s.getPath().getName() for s in files.listStatus(folder)) if n.endswith(".json"))
    if not names:
        return None
    found = json.loads(spark.read.option("wholetext", True).text(f"{table.folder}/manifests/{names[-1]}").first()["value"])
    buckets = {int(b): f for b, f in found["files"].items()}
    return Manifest(found["version"], StructType.fromJson(found["columns"]), buckets, found["buckets"])


def _publish(spark: SparkSession, table: MergedTable, new: Manifest) -> None:
    name = f"{table.folder}/manifests/{new.version:09d}"
    files, draft = _files(spark, f"{name}.{uuid.uuid4().hex}.draft")
    text = json.dumps({"version": new.version, "columns": new.columns.jsonValue(), "files": new.files, "buckets": new.buckets})
    out = files.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    final = spark._jvm.org.apache.hadoop.fs.Path(f"{name}.json")
    if files.exists(final) or not files.rename(draft, final):
        files.delete(draft, False)
        raise RuntimeError(f"another merge has published version {new.version} of {table.folder}")


def _read_buckets(spark: SparkSession, table: MergedTable, current: Manifest, buckets: Sequence[int]) -> DataFrame:
    paths = [f"{table.folder}/data/{current.files[b]}/bucket={b}" for b in buckets if b in current.files]
    if not paths:
        return spark.createDataFrame([], current.columns)
    return spark.read.schema(current.columns).parquet(*paths)


def read_merged(spark: SparkSession, table: MergedTable) -> DataFrame | None:
    """All rows as of the newest manifest."""
    current = manifest(spark, table)
    return None if current is None else _read_buckets(spark, table, current, sorted(current.files))


def _bucket(keys: Sequence[Column], n: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int").alias("bucket")


def rows_near(spark: SparkSession, table: MergedTable, keys: DataFrame) -> DataFrame | None:
    """All rows of the buckets in which a row of ``keys`` (the table's key columns and types) belongs; None before the first merge."""
    current = manifest(spark, table)
    if current is None:
        return None
    touched = keys.select(_bucket([F.col(k) for k in table.keys], current.buckets)).distinct().collect()  # one per bucket at most
    return _read_buckets(spark, table, current, sorted(r["bucket"] for r in touched))


def lookup(spark: SparkSession, table: MergedTable, wanted: Sequence[tuple]) -> DataFrame | None:
    """Rows of a few keys, each a tuple in the order of ``table.keys``; None before the first merge.

    Only the buckets of these keys are opened; the comparison reaches the scan, which skips row groups by their
    smallest and largest key. Unknown keys and keys with a null have no row.
    """
    current = manifest(spark, table)
    if current is None:
        return None
    types = StructType([current.columns[k] for k in table.keys])
    wanted = [tuple(w) for w in wanted if None not in w]
    rows = rows_near(spark, table, spark.createDataFrame(wanted, types))
    same = [reduce(and_, (F.col(f.name) == F.lit(v).cast(f.dataType) for f, v in zip(types, w))) for w in wanted]
    return rows.where(reduce(or_, same, F.lit(False)))


def merge_rows(delta: DataFrame, table: MergedTable, order: Sequence[str] = (), version: int | None = None) -> Manifest | None:
    """Merge ``delta`` into the table, which is made by the first merge. ``order`` says which of equal keys comes first.

    ``version`` is the one the delta was derived from (0: none yet); it is an error if the table has another by now.
    """
    spark = delta.sparkSession
    current = manifest(spark, table)
    if version is not None and version != (current.version if current else 0):
        raise RuntimeError(f"another merge has changed {table.folder} since version {version}")
    columns = StructType([f for f in delta.schema]) if current is None else current.columns
    n = table.buckets if current is None else current.buckets
    if sorted(delta.columns) != sorted(columns.names):
        raise ValueError(f"the table has the columns {columns.names}, the delta {delta.columns}")
    if "bucket" in (c.lower() for c in columns.names):
        raise ValueError("a merged table cannot have a column named bucket")
    known = delta.na.drop(subset=list(table.keys)).select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in columns))
    keys = [F.col(k) for k in table.keys]

    def packed(rows: DataFrame, stored: bool) -> DataFrame:
        # rows travel as structs, so that no column can clash
        return rows.select(_bucket(keys, n), F.lit(stored).alias("stored"), F.struct(*columns.names).alias("row"))

    delta = None
    if current is None:
        rows = packed(known, False)
    else:
        # written, as its buckets are asked for before its rows
        delta = materialize(known, "merge-delta")
        rows = packed(delta, False)
        touched = [r["bucket"] for r in rows.select("bucket").distinct().collect()]  # n at most
        rows = packed(_read_buckets(spark, table, current, touched), True).union(rows)
    version = 1 if current is None else current.version + 1
    target = f"{version:09d}-{uuid.uuid4().hex}"
    if current is None or touched:
        # one shuffle, by bucket: it serves the first row of a key, the meeting of old and new, and the files
        row, marks = F.col("row"), [f"k{i}" for i in range(len(table.keys))]
        place = F.struct(F.struct(F.lit(0), *(row[c] for c in order)).alias("order"), row)
        sides = F.when(F.col("stored"), row).alias("old"), F.when(~F.col("stored"), place).alias("new")
        dealt = rows.repartition("bucket").select("bucket", *(row[k].alias(m) for k, m in zip(table.keys, marks)), *sides)
        joined = dealt.groupBy("bucket", *marks).agg(F.min("old").alias("old"), F.min("new")["row"].alias("new"))
        kept, latest = F.col("old").isNotNull(), F.col("new").isNull()
        merged = [
            F.when(latest if c in table.overwrite else kept, F.col("old")[c]).otherwise(F.col("new")[c]).alias(c) for c in columns.names
        ]
        rows = joined.sortWithinPartitions("bucket", *marks).select("bucket", F.struct(*merged).alias("row"))
        # the files hold the table's columns only: the bucket is in the folder's name
        rows.select("row.*", "bucket").write.partitionBy("bucket").parquet(f"{table.folder}/data/{target}")
    if current is None:
        touched = _written_buckets(spark, f"{table.folder}/data/{target}")
    else:
        drop_table(delta)
    if not touched:
        return current
    files = {**({} if current is None else current.files), **{b: target for b in touched}}
    published = Manifest(version, columns, files, n)
    _publish(spark, table, published)
    return published


def _written_buckets(spark: SparkSession, path: str) -> list[int]:
    files, folder = _files(spark, path)
    names = [s.getPath().getName() for s in files.listStatus(folder)]
    return [int(n.removeprefix("bucket=")) for n in names if n.startswith("bucket=")]


def vacuum(spark: SparkSession, table: MergedTable) -> int:
    """Delete data that the newest manifest does not name; no merge and no reader of older versions may run. Folders deleted."""
    current = manifest(spark, table)
    files, folder = _files(spark, f"{table.folder}/data")
    if current is None or not files.exists(folder):
        return 0
    used = {f"{name}/bucket={b}" for b, name in current.files.items()}
    deleted = 0
    for merge in files.listStatus(folder):
        name = merge.getPath().getName()
        for part in files.listStatus(merge.getPath()):
            bucket = part.getPath().getName()
            if bucket.startswith("bucket=") and f"{name}/{bucket}" not in used:
                deleted += bool(files.delete(part.getPath(), True))
    return deleted
