"""Session settings and the one place where intermediate tables are written."""

from __future__ import annotations

import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job of this library expects. AQE splits skewed join partitions
# and coalesces small shuffle partitions, so the partition count is an upper bound.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def build_session(app_name: str, master: str | None = None, extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster such a
    folder exists on one machine and is lost with it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="casegraph-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


_tables: list[str] = []  # written by this process and not dropped yet
_path_of: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def new_folder(spark: SparkSession, name: str) -> str:
    """An unused path in the shared folder; ``drop_tables`` deletes what is written there."""
    path = f"{shared_folder(spark)}/casegraph-{name}-{uuid.uuid4().hex}"
    _tables.append(path)
    return path


def _delete(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True))


def drop_tables(spark: SparkSession) -> int:
    """Delete the intermediate tables this process wrote. DataFrames that read them cannot be used any more."""
    dropped = 0
    while _tables:
        dropped += _delete(spark, _tables.pop())
    return dropped


def drop_table(table: DataFrame) -> bool:
    """Delete one table that ``materialize`` returned, as soon as nothing reads it any more."""
    path = _path_of.pop(table, None)
    if path is None or path not in _tables:
        return False
    _tables.remove(path)
    return _delete(table.sparkSession, path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    Cuts the lineage, fixes the outcome of anything that depends on sampled range
    bounds, and survives the loss of executors because the files are on shared storage.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.mode("errorifexists").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _path_of[table] = path
    return table


def fits(df: DataFrame, max_rows: int) -> bool:
    """True if ``df`` has at most ``max_rows`` rows; reads no more than one row beyond the bound."""
    return df.limit(max_rows + 1).count() <= max_rows


def checked(df: DataFrame, max_rows: int = 0) -> DataFrame:
    """``df`` as a side of a join that Spark may broadcast only if it has at most ``max_rows`` rows; with 0, never.

    Spark goes by the size of compressed files, and takes rows made by an explode or an aggregation for as small as what
    they are made of. In the driver's memory a table of a few megabytes can be a hundred times larger.
    """
    return df if max_rows and fits(df, max_rows) else df.hint("merge")


def at_once(jobs: Sequence[Callable[[], object]], most: int | None = None) -> list:
    """Results of a few independent jobs submitted together (``most`` at a time), so that short ones fill the gaps of long ones."""
    with ThreadPoolExecutor(max(1, min(len(jobs), most or len(jobs)))) as pool:
        return list(pool.map(lambda job: job(), jobs))


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it, what a query shuffled is deleted when the query ends, and not when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
