"""Entity extraction over notes that keep arriving.

The stream reads new note files, drops notes it has seen before, extracts mentions, and stores one folder per batch.
Which notes were seen is state of the stream (a hash per note, in the state store, by its checkpoint): no batch reads
what earlier ones stored. A batch that is replayed after a failure starts from the state before it and overwrites its own
folder, and the view over all batches is a set union, so every note counts once whatever is repeated.

The state grows by a hash per different note. With ``RECOMMENDED_CONF`` it is kept by RocksDB on the executors' disks
and copied to the checkpoint; its number of partitions is that of ``spark.sql.shuffle.partitions`` at the first start.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from casegraph.operators.entities import LIST_OF_KIND, complete_entity_sets, entity_sets, union_entity_sets

NOTE_SCHEMA = T.StructType([T.StructField("hadm_id", T.LongType()), T.StructField("text", T.StringType())])


def note_hash(id_col: str = "hadm_id", text_col: str = "text"):
    return F.sha2(F.concat_ws("|", F.col(id_col).cast("string"), F.col(text_col)), 256)


def start_extraction(
    spark: SparkSession,
    notes_dir: str,
    store_dir: str,
    checkpoint_dir: str,
    extract: Callable[[DataFrame], DataFrame],
    max_files_per_batch: int | None = None,
) -> StreamingQuery:
    """Process all note files that are new since the last run, then stop.

    ``extract`` maps notes (hadm_id, text) to mentions (hadm_id, term, kind). A note whose text came for the same case
    before is skipped. Progress and state are in ``checkpoint_dir``; both it and ``store_dir`` must be on shared storage.
    """
    reader = spark.readStream.schema(NOTE_SCHEMA)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    incoming = reader.parquet(notes_dir).where(F.col("hadm_id").isNotNull() & F.col("text").isNotNull())
    fresh = incoming.withColumn("note_hash", note_hash()).dropDuplicates(["note_hash"])

    def store(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            sets = complete_entity_sets(entity_sets(extract(batch.select("hadm_id", "text"))), batch)
            sets.write.mode("overwrite").parquet(f"{store_dir}/entities/batch={batch_id}")
            batch.select("hadm_id", "note_hash").write.mode("overwrite").parquet(f"{store_dir}/done/batch={batch_id}")
        finally:
            batch.unpersist()

    return (
        fresh.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def read_done(spark: SparkSession, store_dir: str) -> DataFrame | None:
    """Notes processed so far as (hadm_id, note_hash, batch); None before the first batch."""
    path = f"{store_dir}/done"
    if not _exists(spark, path):
        return None
    return spark.read.schema("hadm_id bigint, note_hash string, batch bigint").parquet(path)


def read_entities(spark: SparkSession, store_dir: str) -> DataFrame:
    """Entity lists per case over all batches."""
    schema = "hadm_id bigint, " + ", ".join(f"{c} array<string>" for c in LIST_OF_KIND.values()) + ", batch bigint"
    stored = spark.read.schema(schema).parquet(f"{store_dir}/entities")
    return union_entity_sets(stored)
