import numpy as np
import pytest
from pyspark.sql import functions as F

from casegraph.operators import knn
from casegraph.operators import vector_index as vi


def rows(n, dim, clusters, seed, spread=0.05):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(clusters, dim))
    of = rng.integers(0, clusters, n)
    copies = rng.random(n) < 0.4  # so many rows are one vector
    return [(i, (middles[0] if copies[i] else middles[of[i]] + spread * rng.normal(size=dim)).tolist()) for i in range(n)]


def frame(spark, data):
    return spark.createDataFrame(data, "id long, embedding array<double>").repartition(4)


def pairs(df):
    return sorted((r.query_id, r["rank"], r.neighbor_id, round(r.distance, 9)) for r in df.collect())


@pytest.fixture(scope="module")
def clustered(spark, tmp_path_factory):
    corpus = frame(spark, rows(3000, 16, 30, 1)).cache()
    index = vi.build_index(corpus, str(tmp_path_factory.mktemp("index") / "cells"), cells=30, shard_rows=200)
    yield corpus, index
    corpus.unpersist()


def test_every_vector_is_indexed_and_hot_cells_are_dealt_out(spark, clustered):
    corpus, index = clustered
    assert index.rows.sum() == 3000 == index.lists.select("id").distinct().count()
    shards = index.lists.groupBy("cell", "shard").count().agg(F.max("count")).first()[0]
    assert index.rows.max() > 1000 and shards < 300


def test_approximate_search_finds_most(spark, clustered):
    corpus, index = clustered
    queries = corpus.where("id % 50 = 0")
    exact = knn.nearest(queries, corpus, 5)
    found = vi.recall(vi.search(queries, index, 5, probes=4), exact).first()
    assert found.n_neighbors == 300 and found.recall >= 0.9


def test_probes_reach_the_recall(spark, tmp_path):
    """Vectors without clusters: many cells must be read, and as many are."""
    corpus = frame(spark, rows(1500, 24, 1500, 4))
    index = vi.build_index(corpus, str(tmp_path / "index"))
    queries = corpus.where("id % 50 = 0")
    probes = vi.probes_for(index, 5)
    assert 8 < probes < len(index.centres)
    exact = knn.nearest(queries, corpus, 5)
    assert vi.recall(vi.search(queries, index, 5), exact).first().recall >= 0.9
    assert vi.recall(vi.search(queries, index, 5, probes=1), exact).first().recall < 0.9


def test_exact_search_meets_few_cells_and_loses_nothing(spark, clustered):
    corpus, index = clustered
    queries = corpus.where("id % 50 = 0")
    assert pairs(vi.search_exact(queries, index, 5, block_rows=7)) == pairs(knn.nearest(queries, corpus, 5))
    met = vi.share_met(queries, index, 5).first()
    assert met.pairs == 60 * len(index.centres) and met.pairs_met < 0.3 * met.pairs and met.share_compared < 0.5


def test_a_query_travels_once_to_each_pack_of_cells(spark, tmp_path):
    """Vectors without clusters: all cells are met, but the copies of a query follow the packs of ``shard_rows`` vectors."""
    corpus = frame(spark, rows(1200, 24, 1200, 5))
    index = vi.build_index(corpus, str(tmp_path / "index"), cells=40, shard_rows=300)
    packs = int((index.packs + index.shards).max())
    assert packs < len(index.centres) / 3
    load = np.zeros(packs)
    for pack, n, shards in zip(index.packs, index.rows, index.shards):
        load[pack : pack + shards] += n / shards
    assert load.max() <= 300
    met = vi.reachable_cells(vi._asked(corpus, index, "id", "embedding"), index, 5)
    assert met.count() <= 1200 * packs < met.select(F.explode("cells")).count()
    assert pairs(vi.search_exact(corpus, index, 5, block_rows=100)) == pairs(knn.nearest(corpus, corpus, 5, max_sent_queries=0))


def test_repeated_ids_are_no_neighbours_of_their_own(spark):
    corpus = frame(spark, [(1, [0.0]), (1, [0.0]), (2, [1.0])])
    assert {(r.query_id, r.neighbor_id) for r in knn.nearest(corpus, corpus, 2, max_sent_queries=0).collect()} == {(1, 2), (2, 1)}


def test_exact_search_of_unclustered_ties_and_bad_vectors(spark, tmp_path):
    rng = np.random.default_rng(3)
    data = [(i, rng.integers(0, 3, 4).astype(float).tolist()) for i in range(300)]
    data += [(1000, None), (1001, [1.0, None, 0.0, 0.0]), (1002, [1.0, float("nan"), 0.0, 0.0]), (None, [0.0] * 4)]
    corpus = frame(spark, data)
    index = vi.build_index(corpus, str(tmp_path / "index"), shard_rows=10)
    known = corpus.where("id IS NOT NULL")
    assert pairs(vi.search_exact(corpus, index, 7)) == pairs(knn.nearest(known, known, 7))
    strangers = frame(spark, [(-1, [9.0] * 4), (-2, [0.0] * 4), (-3, None)])
    assert pairs(vi.search_exact(strangers, index, 3)) == pairs(knn.nearest(strangers, known, 3))
    again = vi.open_index(spark, str(tmp_path / "index"))
    assert pairs(vi.search_exact(strangers, again, 3)) == pairs(knn.nearest(strangers, known, 3))


def test_few_vectors_and_none(spark, tmp_path):
    two = frame(spark, [(1, [0.0, 1.0]), (2, [0.0, 2.0])])
    index = vi.build_index(two, str(tmp_path / "two"))
    assert pairs(vi.search_exact(two, index, 5)) == [(1, 1, 2, 1.0), (2, 1, 1, 1.0)]
    assert pairs(vi.search(two, index, 5)) == [(1, 1, 2, 1.0), (2, 1, 1, 1.0)]
    empty = vi.build_index(two.limit(0), str(tmp_path / "none"))
    assert vi.search(two, empty, 5).count() == 0 == vi.search_exact(two, empty, 5).count()
    assert vi.search(two.limit(0), index, 5).count() == 0 == vi.search_exact(two.limit(0), index, 5).count()
