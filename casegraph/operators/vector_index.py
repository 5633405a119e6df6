"""Index of vectors by cells, for approximate and for exact nearest neighbours.

``build_index`` chooses cell centres from a bounded sample (``sample_rows`` ids with the smallest hashes), puts every
vector into the cell of its nearest centre, and writes the cells' lists: Parquet partitioned by cell, with each vector's
distance to the centre. A cell with many vectors is dealt out to shards, so that no task holds more than about
``shard_rows`` of one cell, however the vectors crowd.

``search`` reads a few cells per query (approximate). ``search_exact`` first searches the nearest cell for an upper bound
of the k-th distance and then only the cells that can hold something nearer: by the triangle inequality a vector at
distance r from a centre is at least |d - r| away from a query at distance d, and the cell's smallest and largest r are
kept. Both never compare a query with a cell that it does not meet. Cells are put together to packs of about ``shard_rows``
vectors, and a query travels once to each pack in which it meets a cell, with the numbers of these cells: so its copies follow the
number of packs, also where it must meet every cell. A query block and a pack meet in one bounded group.

* vectors that ``knn.unusable_vectors`` reports are set aside, on either side; another length is an error;
* rows with the id of the query are no neighbours of it; equal distances are ordered by id; null ids are left out;
* fewer than k others: all of them; an empty corpus: no rows; queries need not be in the corpus;
* columns other than id and vector are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casegraph.operators.knn import _PAIR_SCHEMA, _ids, _length, _matrix, _merge, _pairs, _prepared, _top_k, nearest_of_few
from casegraph.session import materialize

MAX_CELLS = 4096
_ROUNDS = 10
# Numbers in an array of distances, and queries' copies in a batch that a task hands on.
_TILE = 2_000_000
_SENT_ROWS = 16_384


@dataclass(frozen=True)
class VectorIndex:
    lists: DataFrame  # id, v, cell, shard, r (distance to the centre)
    centres: np.ndarray
    rows: np.ndarray  # vectors of each cell
    nearest: np.ndarray  # smallest and largest distance to the centre
    farthest: np.ndarray
    shard_rows: int

    @property
    def shards(self) -> np.ndarray:
        return np.maximum(1, -(-self.rows // self.shard_rows))

    @property
    def packs(self) -> np.ndarray:
        """Pack of each cell; a cell of several shards has one to itself for each, of which this is the first."""
        out, pack, filled = np.zeros(len(self.rows), dtype=np.int64), 0, 0
        for cell, (rows, shards) in enumerate(zip(self.rows.tolist(), self.shards.tolist())):
            if filled and (shards > 1 or filled + rows > self.shard_rows):
                pack, filled = pack + 1, 0
            out[cell] = pack
            pack, filled = (pack + shards, 0) if shards > 1 else (pack, filled + rows)
        return out


def _distances(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    squared = np.einsum("ij,ij->i", vectors, vectors)[:, None] + np.einsum("ij,ij->i", centres, centres) - 2 * vectors @ centres.T
    return np.sqrt(np.maximum(squared, 0.0))


def _nearest(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Number of the nearest centre, in slices, so that memory does not follow the number of vectors."""
    step = max(1, _TILE // max(1, len(centres)))
    found = [np.argmin(_distances(vectors[i : i + step], centres), axis=1) for i in range(0, len(vectors), step)]
    return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)


def _fit_centres(sample: np.ndarray, cells: int) -> np.ndarray:
    """Lloyd rounds over the sample, from evenly spread rows of it; empty cells are dropped."""
    centres = sample[np.linspace(0, len(sample) - 1, min(cells, len(sample))).astype(int)]
    for _ in range(_ROUNDS):
        of = _nearest(sample, centres)
        used, place = np.unique(of, return_inverse=True)
        sums = np.zeros((len(used), sample.shape[1]))
        np.add.at(sums, place, sample)
        centres = sums / np.bincount(place)[:, None]
    return centres


def build_index(
    corpus: DataFrame, path: str, id_col: str = "id", vector_col: str = "embedding", cells: int | None = None,
    sample_rows: int = 20_000, shard_rows: int = 65_536,
) -> VectorIndex:
    """Write the index of ``corpus`` to ``path`` and open it. ``cells`` is the root of the number of vectors by default."""
    stored = _prepared(corpus, id_col, vector_col).where(F.col("id").isNotNull())
    n = stored.count()
    cells = min(MAX_CELLS, cells or max(1, math.isqrt(n)))
    sample = stored.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("v").collect()
    dim = len(sample[0]["v"]) if sample else 0
    centres = _fit_centres(np.array([r["v"] for r in sample], dtype=float), cells) if sample else np.zeros((0, 0))

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if not len(frame):
                continue
            vectors = np.stack(frame["v"].to_numpy())
            cell = _nearest(vectors, centres)
            # element by element, so that rounding does not depend on the batch
            r = np.sqrt(((vectors - centres[cell]) ** 2).sum(axis=1))
            yield frame.assign(cell=cell.astype(np.int32), r=r)

    placed = stored.mapInPandas(place, "id bigint, v array<double>, cell int, r double")
    # a cell is written by one task for each of its shards, and so is a small number of files
    spread = F.pmod(F.xxhash64("id"), F.lit(max(1, -(-n // shard_rows))))
    placed.repartition("cell", spread).write.mode("overwrite").partitionBy("cell").parquet(f"{path}/lists")
    spark = corpus.sparkSession
    facts = _read_lists(spark, path).groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("r").alias("low"), F.max("r").alias("high"))
    found = {r["cell"]: r for r in facts.collect()}  # a row per cell
    rows = [
        (c, centres[c].tolist(), found[c]["n"] if c in found else 0, *((found[c]["low"], found[c]["high"]) if c in found else (0.0, 0.0)))
        for c in range(len(centres))
    ]
    schema = "cell int, centre array<double>, n bigint, low double, high double"
    meta = spark.createDataFrame(rows, schema).withColumns({"dim": F.lit(dim), "shard_rows": F.lit(shard_rows)})
    meta.coalesce(1).write.mode("overwrite").parquet(f"{path}/cells")
    return open_index(spark, path)


def _read_lists(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("id bigint, v array<double>, r double, cell int").parquet(f"{path}/lists")


def open_index(spark: SparkSession, path: str) -> VectorIndex:
    schema = "cell int, centre array<double>, n bigint, low double, high double, dim int, shard_rows int"
    cells = sorted(spark.read.schema(schema).parquet(f"{path}/cells").collect(), key=lambda r: r["cell"])

    def column(name: str) -> np.ndarray:
        return np.array([r[name] for r in cells])

    shard_rows = cells[0]["shard_rows"] if cells else 1
    centres = np.array([r["centre"] for r in cells], dtype=float).reshape(len(cells), cells[0]["dim"] if cells else 0)
    lists = _read_lists(spark, path)
    index = VectorIndex(lists, centres, column("n"), column("low"), column("high"), shard_rows)
    if not cells:
        return index
    shards = F.element_at(F.array(*(F.lit(int(s)) for s in index.shards)), F.col("cell") + 1)
    return VectorIndex(lists.withColumn("shard", F.pmod(F.xxhash64("id"), shards)), centres, index.rows, index.nearest, index.farthest, shard_rows)


def _asked(queries: DataFrame, index: VectorIndex, id_col: str, vector_col: str) -> DataFrame:
    dim = index.centres.shape[1] or _length(queries, vector_col)
    return _prepared(queries, id_col, vector_col, dim).where(F.col("id").isNotNull())


def _meetings(asked: DataFrame, index: VectorIndex, choose: Callable[[np.ndarray, np.ndarray], np.ndarray], bounded: bool = False) -> DataFrame:
    """``id, v, pack, cells``: each query once for each pack of which it meets ``cells``. ``choose`` names them for some vectors
    (and their column ``bound``): a mask of queries by cells."""
    packs, shards = index.packs, index.shards
    # one place of a row for each pack; a cell of several shards is in several
    first, last = packs, packs + shards
    n_packs = int(last.max(initial=0))
    step = max(1, min(_TILE // max(1, len(packs)), _SENT_ROWS // max(1, n_packs)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                bound = _ids(part.column(2)).astype(float) if bounded else np.zeros(0)
                query, cell = np.nonzero(choose(_matrix(part.column(1)), bound))
                if not len(query):
                    continue
                n = (last - first)[cell]
                pack = np.repeat(first[cell], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                query, cell = np.repeat(query, n), np.repeat(cell, n)
                order = np.lexsort((cell, pack, query))
                query, pack, cell = query[order], pack[order], cell[order]
                begins = np.flatnonzero(np.append(True, (query[1:] != query[:-1]) | (pack[1:] != pack[:-1])))
                of = pa.array(query[begins])
                lists = pa.ListArray.from_arrays(pa.array(np.append(begins, len(query)), pa.int32()), pa.array(cell, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(of), part.column(1).take(of), pa.array(pack[begins], pa.int32()), lists], names=["id", "v", "pack", "cells"]
                )

    return asked.mapInArrow(run, "id bigint, v array<double>, pack int, cells array<int>")


def _meet(meetings: DataFrame, index: VectorIndex, k: int, block_rows: int) -> DataFrame:
    """The k nearest per query among the rows of the cells it meets, and fewer where these have fewer."""
    met = meetings.groupBy("pack").agg(F.count(F.lit(1)).alias("n")).collect()  # a row per pack
    blocks = {r["pack"]: -(-r["n"] // block_rows) for r in met}
    n_packs = int((index.packs + index.shards).max(initial=1))
    n_blocks = F.element_at(F.array(*(F.lit(int(blocks.get(p, 1))) for p in range(n_packs))), F.col("pack") + 1)
    pack = F.element_at(F.array(*(F.lit(int(p)) for p in index.packs)), F.col("cell") + 1)
    left = meetings.withColumn("block", F.pmod(F.xxhash64("id"), n_blocks).cast("int"))
    # only lists of cells in packs that are met are read
    wanted = index.lists.where(F.col("cell").isin([c for c, (p, s) in enumerate(zip(index.packs, index.shards)) if not blocks.keys().isdisjoint(range(p, p + s))]))
    right = wanted.withColumn("pack", (pack + F.col("shard")).cast("int")).select(
        "id", "v", "cell", "pack", F.explode(F.sequence(F.lit(0), n_blocks - 1)).alias("block")
    )
    keys = ("pack", "block")

    def compare(some_queries: pa.Table, some_rows: pa.Table) -> pa.Table:
        if not some_queries.num_rows or not some_rows.num_rows:
            return _pairs((np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)))
        return _pairs(_top_k_of_cells(some_queries, some_rows, k))

    return _merge(left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, _PAIR_SCHEMA), k)


def _top_k_of_cells(some_queries: pa.Table, some_rows: pa.Table, k: int, tile: int = 512) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``_top_k``, among the rows of the cells that a query meets. Queries that meet like cells are compared together."""
    query_ids, queries = _ids(some_queries.column("id")), _matrix(some_queries.column("v"))
    ids, rows, of = _ids(some_rows.column("id")), _matrix(some_rows.column("v")), _ids(some_rows.column("cell"))
    cells, of = np.unique(of, return_inverse=True)
    lists = some_queries.column("cells").combine_chunks()
    lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
    begin = np.append(0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)))
    met = lists.flatten().to_numpy(zero_copy_only=False)
    order = np.lexsort((met[np.maximum(begin[1:] - 1, 0)], met[np.minimum(begin[:-1], len(met) - 1)]))
    found = []
    for start in range(0, len(order), tile):
        some = order[start : start + tile]
        mask = np.zeros((len(some), len(cells)), dtype=bool)
        for i, q in enumerate(some.tolist()):
            own = met[begin[q] : begin[q + 1]]
            place = np.minimum(np.searchsorted(cells, own), len(cells) - 1)
            mask[i, place[cells[place] == own]] = True
        used = mask.any(axis=0)
        near = np.flatnonzero(used[of]) if not used.all() else slice(None)
        whole = mask[:, used].all()
        of_near = of[near]
        meets = None if whole else (lambda s, mask=mask, of_near=of_near: mask[s][:, of_near])
        found.append(_top_k(query_ids[some], queries[some], ids[near], rows[near], k, meets))
    return tuple(np.concatenate(part) for part in zip(*found))


def _nothing(asked: DataFrame) -> DataFrame:
    return asked.select(
        F.col("id").alias("query_id"), F.col("id").alias("neighbor_id"), F.lit(0.0).alias("distance"), F.lit(0).alias("rank")
    ).limit(0)


def probes_for(index: VectorIndex, k: int = 5, target: float = 0.95, sample: int = 200) -> int:
    """Cells a query must read to find the share ``target`` of its k nearest, by an exact search for ``sample`` indexed vectors.

    The sample (the ids with the smallest hashes) is bounded, so the scan for it costs the same per indexed vector at any size.
    """
    chosen = index.lists.orderBy(F.xxhash64("id", F.lit(1)), "id").limit(sample).select("id", "v")
    chosen = materialize(chosen, "probe-sample")
    exact = nearest_of_few(chosen, index.lists.select("id", "v"), k)
    cells = index.lists.select(F.col("id").alias("neighbor_id"), "cell")
    found = exact.join(cells, "neighbor_id").select("query_id", "cell").collect()  # k rows per sampled vector
    vectors = {r["id"]: np.array(r["v"]) for r in chosen.collect()}
    if not found:
        return len(index.centres)
    distance = _distances(np.stack([vectors[r["query_id"]] for r in found]), index.centres)
    own = distance[np.arange(len(found)), [r["cell"] for r in found]]
    place = np.sort((distance < own[:, None]).sum(axis=1))
    return int(place[min(len(place) - 1, math.ceil(target * len(place)) - 1)]) + 1


def search(
    queries: DataFrame, index: VectorIndex, k: int = 5, id_col: str = "id", vector_col: str = "embedding",
    probes: int | None = None, block_rows: int = 16_384,
) -> DataFrame:
    """(query_id, neighbor_id, distance, rank): the k nearest of the ``probes`` cells with the nearest centres. Approximate;
    without ``probes`` as many as ``probes_for`` finds."""
    asked = _asked(queries, index, id_col, vector_col)
    centres = index.centres
    if not len(centres):
        return _nothing(asked)
    probes = probes or probes_for(index, k)
    last = min(probes, len(centres)) - 1

    def choose(vectors: np.ndarray, _: np.ndarray) -> np.ndarray:
        distance = _distances(vectors, centres)
        return distance <= np.partition(distance, last, axis=1)[:, last, None]

    return _meet(materialize(_meetings(asked, index, choose), "probed-cells"), index, k, block_rows)


def reachable_cells(asked: DataFrame, index: VectorIndex, k: int, block_rows: int = 16_384) -> DataFrame:
    """``id, v, pack, cells``: the cells of each pack that can hold one of the k nearest of a query (id, v)."""
    centres, low, high, index_rows = index.centres, index.nearest, index.farthest, index.rows

    def nearest_cell(vectors: np.ndarray, _: np.ndarray) -> np.ndarray:
        distance = _distances(vectors, centres)
        return distance == distance.min(axis=1, keepdims=True)

    first = _meet(materialize(_meetings(asked, index, nearest_cell), "nearest-cells"), index, k, block_rows)
    bounds = first.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.sqrt("distance").alias("bound"))
    bounds = materialize(bounds, "distance-bounds")
    bounded = asked.join(bounds, "id", "left").select("id", "v", F.coalesce("bound", F.lit(float("inf"))).alias("bound"))

    def can_hold(vectors: np.ndarray, bound: np.ndarray) -> np.ndarray:
        distance = _distances(vectors, centres)
        slack = 1e-6 * (1.0 + np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None] + high)
        return (distance - high <= bound[:, None] + slack) & (low - distance <= bound[:, None] + slack) & (index_rows > 0)

    return _meetings(bounded, index, can_hold, bounded=True)


def search_exact(
    queries: DataFrame, index: VectorIndex, k: int = 5, id_col: str = "id", vector_col: str = "embedding",
    block_rows: int = 16_384,
) -> DataFrame:
    """As ``knn.nearest``, exactly, but cells that cannot hold a neighbour are not met. Query ids must be unique."""
    asked = _asked(queries, index, id_col, vector_col)
    if not len(index.centres):
        return _nothing(asked)
    met = materialize(reachable_cells(asked, index, k, block_rows), "reachable-cells")
    return _meet(met, index, k, block_rows)


def share_met(queries: DataFrame, index: VectorIndex, k: int = 5, id_col: str = "id", vector_col: str = "embedding") -> DataFrame:
    """One row: pairs of query and cell that meet in an exact search, all pairs, and the share of compared vectors."""
    asked = _asked(queries, index, id_col, vector_col)
    rows = F.element_at(F.array(*(F.lit(int(n)) for n in index.rows)), F.col("cell") + 1)
    # a cell of several shards is named in several packs
    met = reachable_cells(asked, index, k).select("id", F.explode("cells").alias("cell")).distinct()
    met = met.agg(F.count(F.lit(1)).alias("pairs_met"), F.sum(rows).alias("compared"))
    every = asked.agg(F.count(F.lit(1)).alias("n_queries"))
    return met.crossJoin(every).select(
        "pairs_met", (F.col("n_queries") * len(index.centres)).alias("pairs"),
        (F.col("compared") / (F.col("n_queries") * int(index.rows.sum()))).alias("share_compared"),
    )


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: neighbours of the exact result, those of them that were found, and their share."""
    key = ["query_id", "neighbor_id"]
    hits = exact.select(*key).join(found.select(*key).withColumn("hit", F.lit(1)), key, "left")
    counts = hits.agg(F.count(F.lit(1)).alias("n_neighbors"), F.count("hit").alias("n_found"))
    return counts.withColumn("recall", F.col("n_found") / F.nullif("n_neighbors", F.lit(0)))
