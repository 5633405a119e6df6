"""Global shuffle into shards by a two-pass external shuffle, in DataFrame functions only.

Pass one scatters the records uniformly into buckets of about ``bucket_bytes`` by a seeded hash of id and record number,
so rows that repeat, or share an id or a source, are dealt out like any others. Pass two takes one bucket at a time into
memory, shuffles it (``shuffle`` is a Fisher-Yates shuffle of an array) and writes it. Then the counts of the written
buckets give each bucket its place in the global order, and the order is cut into shards: ``rows`` is the law, the
counts of two shards differ by one at most, and ``slot`` is a record's place in its shard. A bucket's records lie in one
shard, or in a few next to each other, so the shard files are written without another shuffle.

The order follows from seed, bucket size and the files read (the record number is that of the scan); a task that is run
again writes the same bucket, and what is placed is counted on written buckets only.

* null texts count no bytes; a text longer than a bucket makes a larger bucket;
* fewer records than shards: some shards are empty; no records: no rows;
* repeated rows are records of their own, null ids are ids like others;
* columns of the input named like a result keep their values under the prefix ``own_``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from casegraph.operators.ranking import prefix_sums
from casegraph.session import drop_table, fits, materialize, new_folder

LAW = "rows"
_RESULTS = ("shard", "slot", "bucket", "place")
#: Bytes a record takes in memory beside its text.
_RECORD_BYTES = 64


@dataclass(frozen=True)
class Settings:
    shards: int = 16
    seed: int = 42
    bucket_bytes: int = 32 << 20
    #: Places of buckets are broadcast up to this checked number of buckets.
    max_broadcast: int = 500_000


def text_size(text: str) -> Column:
    """UTF-8 bytes of the text and one more."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def bucket_count(docs: DataFrame, text: str, settings: Settings) -> int:
    total = docs.agg(F.sum(text_size(text) + _RECORD_BYTES).alias("n")).first()["n"] or 0
    return max(1, math.ceil(total / settings.bucket_bytes))


def shuffled_buckets(docs: DataFrame, id: str, n: int, seed: int) -> DataFrame:
    """``docs`` with ``bucket`` and ``place``: a random order of the records of each of ``n`` buckets."""
    numbered = docs.withColumn("place", F.monotonically_increasing_id())
    bucket = F.pmod(F.xxhash64(F.lit(seed), F.col(id), F.col("place")), F.lit(n))
    scattered = numbered.withColumn("bucket", bucket.cast("int")).repartitionById(n, F.col("bucket"))
    # the order before the shuffle is fixed too: fetched blocks arrive in any order
    sorted_ = scattered.sortWithinPartitions("bucket", "place")
    record = F.struct(*(F.col(c) for c in docs.columns)).alias("record")
    whole = sorted_.groupBy("bucket").agg(F.collect_list(record).alias("records"))
    mixed = whole.select("bucket", F.posexplode(F.shuffle("records", seed)).alias("place", "record"))
    return mixed.select("record.*", "bucket", "place")


def _placed(buckets: DataFrame, settings: Settings) -> DataFrame:
    """``shard`` and ``slot`` of the records of written buckets, from their bucket's place in the global order."""
    counts = materialize(buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")), "bucket-counts")
    total = counts.agg(F.sum("n").alias("n")).first()["n"] or 0
    starts = prefix_sums(counts, "bucket", ["n"]).select("bucket", "before_n")
    starts = F.broadcast(starts) if fits(starts, settings.max_broadcast) else starts
    each, larger = divmod(total, settings.shards)  # so many shards have one record more
    at = F.col("before_n") + F.col("place")
    after = at - larger * (each + 1)
    in_larger = after < 0
    slot = F.when(in_larger, at % (each + 1)).otherwise(after % max(each, 1))
    shard = F.when(in_larger, (at - slot) / (each + 1)).otherwise(larger + (after - slot) / max(each, 1))
    placed = buckets.join(starts, "bucket")
    return placed.withColumns({"shard": shard.cast("int"), "slot": slot.cast("long")}).drop("bucket", "place", "before_n")


def write_shards(
    docs: DataFrame, folder: str, id: str = "doc_id", text: str = "text", settings: Settings = Settings()
) -> StructType:
    """Write ``docs`` to ``folder/shard=<number>`` in random order; the schema of the files is returned for ``read_shards``."""
    docs = docs.withColumnsRenamed({c: f"own_{c}" for c in docs.columns if c.lower() in _RESULTS})
    n = bucket_count(docs, text, settings)
    buckets = materialize(shuffled_buckets(docs, id, n, settings.seed), "shuffled-buckets")
    placed = _placed(buckets, settings)
    placed.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)
    drop_table(buckets)
    return placed.schema


def read_shards(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """The written records with ``shard`` and ``slot``."""
    return spark.read.schema(schema).parquet(folder)


def shard_documents(docs: DataFrame, id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """All records with ``shard`` and ``slot``, read back from shard files in a new folder."""
    folder = new_folder(docs.sparkSession, "shards")
    return read_shards(docs.sparkSession, folder, write_shards(docs, folder, id, text, settings))
