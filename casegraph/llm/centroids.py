"""Integer k-means with a filter on PCA-rotated coordinates.

Vectors become integers, ``floor(scale * x)``, and everything that decides is exact integer arithmetic. Each round
assigns every vector to the nearest centroid (ties: the smaller number) and replaces a centroid by the floor of its
vectors' mean, component by component; a centroid without vectors stays.

The filter: vectors are rotated by the principal axes of all vectors. Stored are the leading rotated coordinates and
the norm of the rest. The squared distance of the leading coordinates plus the squared difference of the norms is a
lower bound of the squared distance, because the rest of two vectors cannot be nearer to each other than their norms
are. So the centroid with the least bound is measured in integers first, then only those whose bound is not above that
distance (with an allowance for the rounding of the bounds).

A round reads the stored vectors once. A task adds up its vectors per centroid; these sums, ``clusters`` rows a task,
are added up by a shuffle, and the driver sees ``clusters`` rows.

* vectors of another length, and those with a null or non-finite component, are left out; so is a null vector;
* a component beyond 2**27 / scale either way is an error: squared distances would not fit in 64 bits;
* fewer vectors than clusters: as many centroids as vectors; no vectors: no rows;
* repeated rows are vectors of their own; null ids come last among the first centroids, and equal ids by components;
* other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegraph.session import drop_table, materialize

_LARGEST = 1 << 27


@dataclass(frozen=True)
class Settings:
    components: int = 64
    clusters: int = 8
    rounds: int = 10
    scale: int = 1024
    #: Part of the text ``<seed>:<id>`` whose hash chooses the first centroids.
    seed: int = 3
    #: Rotated coordinates that are stored.
    leading: int = 16


def integer_vectors(vectors: DataFrame, id: str, vector: str, settings: Settings) -> DataFrame:
    """``id, q`` of the vectors that take part, as integers."""
    infinite = float("inf")
    x = F.col("x")
    usable = (F.size(x) == settings.components) & F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < infinite), F.lit(False)))
    rows = vectors.select(F.col(id).alias("id"), F.col(vector).cast("array<double>").alias("x")).where(F.coalesce(usable, F.lit(False)))

    def whole(v):
        inside = F.abs(v) * settings.scale < _LARGEST
        error = F.raise_error(F.concat(F.lit("component too large: "), v.cast("string"))).cast("int")
        return F.when(inside, F.floor(v * settings.scale).cast("int")).otherwise(error)

    return rows.select("id", F.transform("x", whole).alias("q"))


@dataclass(frozen=True)
class Rotation:
    """Orthonormal axes, the leading ones first, and the point they start from."""

    mean: np.ndarray
    axes: np.ndarray  # a column per axis
    leading: int

    def apply(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leading coordinates and the norm of the rest."""
        turned = (q - self.mean) @ self.axes
        return turned[:, : self.leading], np.sqrt(np.einsum("ij,ij->i", turned[:, self.leading :], turned[:, self.leading :]))


def fit_rotation(rows: DataFrame, settings: Settings) -> Rotation:
    """Principal axes of all vectors; with fewer than two, the axes as they are."""
    n = settings.components
    mean = rows.agg(F.count(F.lit(1)), *(F.avg(F.col("q")[i]) for i in range(n))).first()
    if mean[0] < 2:
        return Rotation(np.zeros(n), np.eye(n), min(settings.leading, n))
    points = rows.select(array_to_vector(F.col("q").cast("array<double>")).alias("v"))
    axes = PCA(k=n, inputCol="v", outputCol="turned").fit(points).pc.toArray()
    return Rotation(np.array(mean[1:], dtype=float), axes, min(settings.leading, n))


def _matrix(column: pa.Array, width: int, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, width)


def rotated(rows: DataFrame, rotation: Rotation) -> DataFrame:
    """``rows`` with ``lead``, the leading rotated coordinates, and ``rest``, the norm of the others."""
    width = len(rotation.mean)
    schema = f"id {rows.schema['id'].dataType.simpleString()}, q array<int>, lead array<double>, rest double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lead, rest = rotation.apply(_matrix(batch.column(1), width, np.float64))
            ends = np.arange(len(rest) + 1, dtype=np.int32) * lead.shape[1]
            lists = pa.ListArray.from_arrays(ends, np.ascontiguousarray(lead).reshape(-1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists, pa.array(rest)], names=["id", "q", "lead", "rest"])

    return rows.mapInArrow(run, schema)


class Nearest:
    """Finds the nearest of some centroids."""

    def __init__(self, centroids: np.ndarray, rotation: Rotation):
        self.centroids = centroids
        self.lead, self.rest = rotation.apply(centroids.astype(float))
        self.size = np.einsum("ij,ij->i", self.lead, self.lead) + self.rest**2

    def find(self, q: np.ndarray, lead: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest centroid, squared distance, and how many centroids were measured, of each vector."""
        rows, size = np.arange(len(q)), np.einsum("ij,ij->i", lead, lead) + rest**2
        bound = size[:, None] + self.size - 2 * (lead @ self.lead.T) - 2 * rest[:, None] * self.rest
        allowance = 1e-9 * (1.0 + size[:, None] + self.size)
        first = np.argmin(bound, axis=1)
        found = self._measure(q, first)
        open_ = bound - allowance <= found[:, None].astype(float)
        open_[rows, first] = False
        best = first.copy()
        for c in range(len(self.centroids)):  # in ascending order, so that of equals the smallest number stays
            near = np.flatnonzero(open_[:, c])
            if len(near):
                distance = self._measure(q[near], np.full(len(near), c))
                better = (distance < found[near]) | ((distance == found[near]) & (c < best[near]))
                best[near[better]], found[near[better]] = c, distance[better]
        return best, found, open_.sum(axis=1) + 1

    def _measure(self, q: np.ndarray, of: np.ndarray) -> np.ndarray:
        gap = q - self.centroids[of]
        return np.einsum("ij,ij->i", gap, gap)


def _stored(batch: pa.RecordBatch, width: int, leading: int):
    q = _matrix(batch.column(batch.schema.get_field_index("q")), width, np.int64)
    lead = _matrix(batch.column(batch.schema.get_field_index("lead")), leading, np.float64)
    return q, lead, batch.column(batch.schema.get_field_index("rest")).to_numpy(zero_copy_only=False)


def cluster_sums(stored: DataFrame, centroids: np.ndarray, rotation: Rotation) -> dict[int, tuple[int, list[int]]]:
    """How many vectors each centroid has, and their sums."""
    k, width = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = Nearest(centroids, rotation)
        count, sums = np.zeros(k, dtype=np.int64), np.zeros((k, width), dtype=np.int64)
        for batch in batches:
            q, lead, rest = _stored(batch, width, rotation.leading)
            if not len(q):
                continue
            best, _, _ = nearest.find(q, lead, rest)
            order = np.argsort(best, kind="stable")
            new = np.flatnonzero(np.diff(best[order], prepend=-1))
            count += np.bincount(best, minlength=k)
            sums[best[order][new]] += np.add.reduceat(q[order], new, axis=0)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(count[used]), pa.array(sums[used].tolist(), type=pa.list_(pa.int64()))],
            names=["cluster", "n", "sums"],
        )

    parts = stored.select("q", "lead", "rest").mapInArrow(run, "cluster int, n long, sums array<long>")
    wide = "decimal(38,0)"  # sums over all data may not fit in 64 bits
    total = parts.groupBy("cluster").agg(F.sum("n"), *(F.sum(F.col("sums")[i].cast(wide)) for i in range(width)))
    return {r[0]: (r[1], [int(v) for v in r[2:]]) for r in total.collect()}


def assigned(stored: DataFrame, centroids: np.ndarray, rotation: Rotation) -> DataFrame:
    """``id, cluster, distance, measured`` of every vector."""
    width = centroids.shape[1]
    schema = f"id {stored.schema['id'].dataType.simpleString()}, cluster int, distance long, measured int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = Nearest(centroids, rotation)
        for batch in batches:
            best, found, measured = nearest.find(*_stored(batch, width, rotation.leading))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(best.astype(np.int32)), pa.array(found), pa.array(measured.astype(np.int32))],
                names=["id", "cluster", "distance", "measured"],
            )

    return stored.mapInArrow(run, schema)


def first_centroids(rows: DataFrame, settings: Settings) -> np.ndarray:
    order = F.sha2(F.concat(F.lit(f"{settings.seed}:"), F.col("id").cast("string")), 256)
    chosen = rows.orderBy(order.asc_nulls_last(), "q").limit(settings.clusters).select("q").collect()
    return np.array([r["q"] for r in chosen], dtype=np.int64).reshape(-1, settings.components)


@dataclass
class Clustering:
    centroids: list[list[int]]
    #: ``id, cluster, distance, measured`` of every vector.
    members: DataFrame


def cluster_vectors(
    vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", settings: Settings = Settings()
) -> Clustering:
    """Centroids after all rounds, and the vectors' places among them."""
    rows = integer_vectors(vectors, id, vector, settings)
    rotation = fit_rotation(rows, settings)
    stored = materialize(rotated(rows, rotation), "rotated-vectors")
    centroids = first_centroids(stored, settings)
    if not len(centroids):
        nothing = stored.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"), F.lit(0).alias("measured"))
        return Clustering([], nothing)
    for _ in range(settings.rounds):
        for c, (n, sums) in cluster_sums(stored, centroids, rotation).items():
            centroids[c] = [s // n for s in sums]
    members = materialize(assigned(stored, centroids, rotation), "cluster-members")
    drop_table(stored)
    return Clustering(centroids.tolist(), members)


def centroid_digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def with_inertia(clustering: Clustering) -> DataFrame:
    """Members with ``cluster_inertia``, ``inertia`` and ``centroid_sha256``."""
    spark = clustering.members.sparkSession
    sums = {r["cluster"]: r["s"] for r in clustering.members.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    facts = [(c, sums.get(c, 0), centroid_digest(v)) for c, v in enumerate(clustering.centroids)]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, centroid_sha256 string")
    joined = clustering.members.join(F.broadcast(facts), "cluster")  # a row per centroid
    return joined.withColumn("inertia", F.lit(sum(sums.values())).cast("long"))
