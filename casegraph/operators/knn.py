"""Exact nearest neighbours by squared Euclidean distance.

Every task keeps only the ``k`` best per query while it reads its rows, so what is
shuffled is ``k`` rows per query and task; pairs are never materialised. Few queries
(checked) travel to the corpus; many are cut into blocks, and the work becomes a grid
of (corpus shard, query block) groups of bounded size.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casegraph.functions.vectors import of_length
from casegraph.session import fits

MAX_SENT_QUERIES = 4096
SHARD_ROWS = 32_768
BLOCK_ROWS = 16_384
# A small grid is cut finer, into this many blocks of at least so many queries, so that no task has it all.
_MIN_BLOCKS, _MIN_BLOCK_ROWS = 12, 512
_TILE_CELLS = 2_000_000


def _matrix(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length, a row each; no copy is made of a single chunk."""
    whole = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    parts = whole.chunks if isinstance(whole, pa.ChunkedArray) else [whole]
    flat = [part.flatten().to_numpy(zero_copy_only=False) for part in parts]
    return (flat[0] if len(flat) == 1 else np.concatenate(flat or [np.zeros(0)])).reshape(len(vectors), -1)


def _ids(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else column.to_numpy()


def _pairs(found: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.Table:
    return pa.table([pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64()), pa.array(found[2], pa.float64())], names=list(_PAIR_COLUMNS))


def _top_k(query_ids, queries, corpus_ids, corpus, k: int, meets: Callable[[slice], np.ndarray] | None = None):
    """Row arrays (query, neighbour, distance) of the k nearest of ``corpus`` per query, self excluded.

    The matrix product only narrows down the candidates (with slack for its rounding);
    their distances are then summed element by element, so equal vectors get equal
    distances and ties are broken by id alone. ``meets`` says for a slice of the queries which rows of the corpus count.
    """
    out_q, out_c, out_d = [], [], []
    norms = np.einsum("ij,ij->i", corpus, corpus)
    step = max(1, _TILE_CELLS // max(1, len(corpus)))
    for start in range(0, len(queries), step):
        block, block_ids = queries[start : start + step], query_ids[start : start + step]
        own = np.einsum("ij,ij->i", block, block)
        # in place, for this is the largest array of a task
        rough = block @ corpus.T
        rough *= -2.0
        rough += own[:, None]
        rough += norms[None, :]
        rough[block_ids[:, None] == corpus_ids[None, :]] = np.inf
        if meets is not None:
            rough[~meets(slice(start, start + step))] = np.inf
        slack = 1e-9 * (1.0 + own + norms.max(initial=0.0))
        if rough.shape[1] > k:
            bound = np.minimum(np.partition(rough, k - 1, axis=1)[:, k - 1] + slack, np.finfo(float).max)
        else:
            bound = np.full(len(block), np.finfo(float).max)
        for i in range(len(block)):
            near = np.flatnonzero(rough[i] <= bound[i])
            exact = ((corpus[near] - block[i]) ** 2).sum(axis=1)
            best = np.lexsort((corpus_ids[near], exact))[:k]
            out_q.append(np.repeat(block_ids[i], len(best)))
            out_c.append(corpus_ids[near][best])
            out_d.append(exact[best])
    if not out_q:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    return np.concatenate(out_q), np.concatenate(out_c), np.concatenate(out_d)


_PAIR_COLUMNS = ("query_id", "neighbor_id", "distance")
_PAIR_SCHEMA = "query_id bigint, neighbor_id bigint, distance double"


def _merge(partial: DataFrame, k: int) -> DataFrame:
    window = Window.partitionBy("query_id").orderBy("distance", "neighbor_id")
    return partial.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def _usable(vector: Column) -> Column:
    infinite = float("inf")
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < infinite), F.lit(False)))
    return F.coalesce(finite, F.lit(False))


def unusable_vectors(df: DataFrame, id_col: str = "id", vector_col: str = "embedding") -> DataFrame:
    """Ids whose vector is null or has an element that is null, NaN or infinite: no distance to them exists."""
    return df.where(~_usable(F.col(vector_col).cast("array<double>"))).select(id_col)


def _prepared(df: DataFrame, id_col: str, vector_col: str, dim: int | None = None) -> DataFrame:
    """Rows with a usable vector; one of another length than ``dim``, that of the first row if it is not given, is an error."""
    dim = _length(df, vector_col) if dim is None else dim
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    return rows.where(_usable(F.col("v"))).withColumn("v", of_length(F.col("v"), dim))


def _length(df: DataFrame, vector_col: str) -> int:
    first = df.where(F.col(vector_col).isNotNull()).select(F.size(vector_col).alias("n")).first()
    return first["n"] if first else 0


def nearest(
    queries: DataFrame, corpus: DataFrame, k: int = 5, id_col: str = "id", vector_col: str = "embedding",
    max_sent_queries: int = MAX_SENT_QUERIES,
) -> DataFrame:
    """(query_id, neighbor_id, distance, rank): the k nearest other cases of each query, ties by id.

    Rows that ``unusable_vectors`` reports are set aside on either side; all vectors must have one length.
    """
    dim = _length(corpus, vector_col) or _length(queries, vector_col)
    asked, stored = (_prepared(df, id_col, vector_col, dim) for df in (queries, corpus))
    if fits(asked, max_sent_queries):
        return nearest_of_few(asked, stored, k)
    return nearest_in_grid(asked, stored, k)


def nearest_of_few(asked: DataFrame, stored: DataFrame, k: int) -> DataFrame:
    """Queries (id, v), at most a few thousand, are sent to every task that scans the corpus."""
    rows = asked.collect()
    query_ids = np.array([r["id"] for r in rows], dtype=np.int64)
    queries = np.array([r["v"] for r in rows], dtype=float)
    sent = stored.sparkSession.sparkContext.broadcast((query_ids, queries))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = sent.value
        best = None
        for batch in batches:
            if not batch.num_rows or not len(ids):
                continue
            found = pd.DataFrame(dict(zip(_PAIR_COLUMNS, _top_k(ids, vectors, _ids(batch.column(0)), _matrix(batch.column(1)), k))))
            best = found if best is None else pd.concat([best, found], ignore_index=True)
            best = best.sort_values(["query_id", "distance", "neighbor_id"], ignore_index=True)
            best = best.groupby("query_id", sort=False).head(k)
        if best is not None:
            yield pa.RecordBatch.from_pandas(best[list(_PAIR_COLUMNS)], preserve_index=False)

    return _merge(stored.select("id", "v").mapInArrow(scan, _PAIR_SCHEMA), k)


def nearest_in_grid(
    asked: DataFrame, stored: DataFrame, k: int, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Any number of queries: each query block meets each corpus shard in one group.

    Shards and blocks are drawn by id hash, so their sizes are even whatever the data looks
    like. Cost is that of all distances; the larger the blocks, the fewer copies are shuffled.
    """
    shards = max(1, math.ceil(stored.count() / shard_rows))
    n = asked.count()
    blocks = max(1, math.ceil(n / block_rows), min(_MIN_BLOCKS, n // _MIN_BLOCK_ROWS))
    left = asked.select(
        "id", "v", F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"),
        F.explode(_numbers(shards)).alias("shard"),
    )
    right = stored.select(
        "id", "v", F.pmod(F.xxhash64("id"), F.lit(shards)).alias("shard"),
        F.explode(_numbers(blocks)).alias("block"),
    )

    def meet(some_queries: pa.Table, some_rows: pa.Table) -> pa.Table:
        if not some_queries.num_rows or not some_rows.num_rows:
            return _pairs(_top_k(np.zeros(0, np.int64), np.zeros((0, 0)), np.zeros(0, np.int64), np.zeros((0, 0)), k))
        return _pairs(
            _top_k(
                _ids(some_queries.column("id")), _matrix(some_queries.column("v")),
                _ids(some_rows.column("id")), _matrix(some_rows.column("v")), k,
            )
        )

    met = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(meet, _PAIR_SCHEMA)
    return _merge(met, k)


def _numbers(n: int):
    return F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))


def lookup(requested: DataFrame, known: DataFrame, id_col: str = "hadm_id") -> DataFrame:
    """Requested ids with ``found``; unknown ones are reported instead of dropped."""
    marked = known.select(id_col).distinct().withColumn("found", F.lit(True))
    return requested.select(id_col).distinct().join(marked, id_col, "left").withColumn(
        "found", F.coalesce("found", F.lit(False))
    )


def neighbour_outcome(neighbours: DataFrame, outcomes: DataFrame, id_col: str = "hadm_id", flag: str = "died") -> DataFrame:
    """Per query the number of neighbours, of those with a known outcome, and the share of the latter that died."""
    known = outcomes.select(F.col(id_col).alias("neighbor_id"), F.col(flag).alias("_flag"))
    return neighbours.join(known, "neighbor_id", "left").groupBy("query_id").agg(
        F.count(F.lit(1)).alias("n_neighbors"),
        F.count("_flag").alias("n_known"),
        F.avg(F.col("_flag").cast("double")).alias("death_rate"),
    )
