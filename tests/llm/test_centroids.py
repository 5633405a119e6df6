import hashlib
import math

import numpy as np

from casegraph.llm import centroids as ce
from casegraph.llm.queries import ORACLES, QUERIES
from oracle import connect, difference


def brute(rows, settings):
    """Plain Lloyd rounds in Python integers: (id, cluster, distance) in input order, and the centroids."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == settings.components and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(settings.scale * float(x)) for x in v]))

    def order(row):
        return (row[0] is None, hashlib.sha256(f"{settings.seed}:{row[0]}".encode()).hexdigest(), row[1])

    centroids = [q for _, q in sorted(kept, key=order)[: settings.clusters]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(q, c)), n) for n, c in enumerate(centroids)) for _, q in kept]

    for _ in range(settings.rounds):
        of = [n for _, n in assign()]
        for n in set(of):
            mine = [q for (_, q), m in zip(kept, of) if m == n]
            centroids[n] = [sum(c) // len(mine) for c in zip(*mine)]
    return [(i, n, d) for (i, _), (d, n) in zip(kept, assign())], centroids


def run(spark, rows, settings, id_type="long"):
    df = spark.createDataFrame(rows, f"vec_id {id_type}, embedding array<float>").repartition(4)
    done = ce.cluster_vectors(df, settings=settings)
    return sorted(((r.id, r.cluster, r.distance) for r in done.members.collect()), key=str), done.centroids


SMALL = ce.Settings(components=3, clusters=5, rounds=4, leading=2)


def check(spark, rows, settings=SMALL):
    want, centroids = brute(rows, settings)
    assert run(spark, rows, settings) == (sorted(want, key=str), centroids)


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    got = QUERIES["op11_centroids"](spark, sf).toPandas()
    assert difference(got, connect(sf).execute(ORACLES["op11_centroids"]).df()) is None


def test_random_clusters(spark):
    rng = np.random.default_rng(1)
    middles = rng.normal(size=(9, 3))
    rows = [(i, (middles[i % 9] + 0.1 * rng.normal(size=3)).astype(np.float32).tolist()) for i in range(400)]
    check(spark, rows)
    check(spark, rows, ce.Settings(components=3, clusters=9, rounds=6, leading=1))


def test_ties_repeated_rows_and_unusable_vectors(spark):
    rows = [(i, [float(i % 2), 0.0, -1.5]) for i in range(40)] + [(7, [1.0, 0.0, -1.5])] * 30 + [(None, [0.25, 0.0, 0.0])] * 2
    rows += [(50, None), (51, [1.0, 2.0]), (52, [1.0, None, 2.0]), (53, [1.0, float("nan"), 2.0]), (54, [1.0, float("inf"), 2.0]), (55, [])]
    check(spark, rows)


def test_fewer_vectors_than_clusters_and_none(spark):
    check(spark, [(1, [0.5, 0.25, 3.0])])
    check(spark, [(1, [0.5, 0.25, 3.0]), (2, [0.5, 0.25, 3.0])])
    assert run(spark, [], SMALL) == ([], [])
    df = ce.with_inertia(ce.cluster_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")))
    assert df.count() == 0 and {"cluster_inertia", "inertia", "centroid_sha256"} <= set(df.columns)


def test_bounds_never_exceed_and_mostly_decide():
    rng = np.random.default_rng(2)
    middles = rng.normal(size=(64, 64)) * 1000
    q = np.floor(middles[rng.integers(0, 64, 3000)] + 50 * rng.normal(size=(3000, 64))).astype(np.int64)
    _, _, axes = np.linalg.svd(q - q.mean(axis=0), full_matrices=False)
    rotation = ce.Rotation(q.mean(axis=0), axes.T, 16)
    centroids = np.floor(middles).astype(np.int64)
    best, found, measured = ce.Nearest(centroids, rotation).find(q, *rotation.apply(q))
    exact = ((q[:, None] - centroids[None]) ** 2).sum(axis=2)
    assert np.array_equal(best, exact.argmin(axis=1)) and np.array_equal(found, exact.min(axis=1))
    assert measured.mean() < 4  # of 64


def test_other_columns_and_large_components(spark):
    df = spark.createDataFrame([(1, [0.5] * 3, 9, 9), (2, [1e6] * 3, 9, 9)], "vec_id long, embedding array<double>, q int, cluster int")
    assert ce.cluster_vectors(df.where("vec_id = 1"), settings=SMALL).members.columns == ["id", "cluster", "distance", "measured"]
    try:
        ce.cluster_vectors(df, settings=SMALL).members.collect()
    except Exception as error:
        assert "component too large" in str(error)
    else:
        raise AssertionError("no error")
