import numpy as np
import pytest
from pyspark.sql import functions as F

from casegraph.operators import knn
from casegraph.operators import metrics as me
from casegraph.operators import model as mo


def scored(spark, rows):
    return spark.createDataFrame(rows, "label int, prob double")


@pytest.mark.parametrize("partitions", [1, 8, 37])
def test_auc_with_ties(spark, settings, partitions):
    settings("spark.sql.shuffle.partitions", str(partitions))
    rng = np.random.default_rng(3)
    y, p = rng.integers(0, 2, 300), rng.integers(0, 20, 300) / 20
    wins = (p[y == 1][:, None] > p[y == 0][None, :]).mean() + 0.5 * (p[y == 1][:, None] == p[y == 0][None, :]).mean()
    got = me.auc(scored(spark, [(int(a), float(b)) for a, b in zip(y, p)])).first()["auc"]
    assert got == pytest.approx(wins, abs=1e-12)


def test_auc_of_one_class_is_null(spark):
    assert me.auc(scored(spark, [(1, 0.5), (1, 0.7)])).first()["auc"] is None
    assert me.auc(scored(spark, [(1, 0.5), (0, 0.5)])).first()["auc"] == 0.5


def test_ratios_without_denominator(spark):
    df = scored(spark, [(0, 0.1), (1, 0.2)]).withColumn("pred", F.lit(0))
    assert tuple(me.precision_recall_f1(df).first()) == (0.0, 0.0, 0.0)
    cells = {(r["label"], r["pred"]): r["n"] for r in me.confusion_matrix(df).collect()}
    assert cells == {(0, 0): 1, (0, 1): 0, (1, 0): 1, (1, 1): 0}


def test_train_score_and_cache(spark, tmp_path):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 2))
    rows = [(i, [float(a), float(b)], int(a + 0.3 * rng.normal() > 0)) for i, (a, b) in enumerate(x)]
    df = spark.createDataFrame(rows, "hadm_id bigint, features array<double>, label int")
    trained = mo.train(df.where("hadm_id < 300"), df.where("hadm_id >= 300"))
    assert trained.validation_auc > 0.9
    calls = []

    def compute():
        calls.append(1)
        return mo.score(trained.model, df).select("hadm_id", "prob")

    first = mo.cached_predictions(spark, str(tmp_path / "p"), compute)
    second = mo.cached_predictions(spark, str(tmp_path / "p"), compute)
    assert calls == [1] and first.count() == second.count() == 400
    assert mo.score(trained.model, df).where("(prob >= 0.5) <> (pred = 1)").count() == 0


def brute_force(ids, vectors, k):
    expected = {}
    for i, v in zip(ids, vectors):
        d = ((vectors - v) ** 2).sum(axis=1)
        order = [j for j in np.lexsort((ids, d)) if ids[j] != i][:k]
        expected[int(i)] = [(int(ids[j]), d[j]) for j in order]
    return expected


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(11)
    data = rng.normal(size=(300, 8))
    data[50:90] = data[10]  # copies: more ties than neighbours asked for
    data[200:220] = np.round(data[200:220])
    ids = rng.permutation(1000)[:300]
    frame = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, data)], "id bigint, embedding array<double>")
    return frame.repartition(5).persist(), ids, data


def check(found, expected, queries):
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["neighbor_id"], r["distance"]))
    assert set(got) == set(queries)
    for q in queries:
        assert [n for n, _ in got[q]] == [n for n, _ in expected[q]]
        assert np.allclose([d for _, d in got[q]], [d for _, d in expected[q]], atol=1e-12)


def test_few_queries_equal_brute_force(vectors):
    frame, ids, data = vectors
    check(knn.nearest(frame, frame, 5), brute_force(ids, data, 5), ids.tolist())


@pytest.mark.parametrize("shard_rows, block_rows", [(1000, 1000), (40, 70), (7, 300)])
def test_grid_equals_brute_force(vectors, shard_rows, block_rows):
    frame, ids, data = vectors
    prepared = knn._prepared(frame, "id", "embedding")
    found = knn.nearest_in_grid(prepared, prepared, 5, shard_rows, block_rows)
    check(found, brute_force(ids, data, 5), ids.tolist())


def test_query_outside_the_corpus_and_small_corpus(spark, vectors):
    frame, ids, data = vectors
    outside = spark.createDataFrame([(5000, data[10].tolist())], "id bigint, embedding array<double>")
    copies = sorted([int(ids[10])] + [int(i) for i in ids[50:90]])[:5]
    for limit in (10, 0):
        found = knn.nearest(outside, frame, 5, max_sent_queries=limit)
        assert [r["neighbor_id"] for r in found.orderBy("rank").collect()] == copies
    three = frame.limit(3).persist()
    assert knn.nearest(three, three, 5).count() == 6
    assert knn.nearest(frame.where("false"), frame, 5).count() == 0


def test_lookup_reports_unknown_ids(spark):
    asked = spark.createDataFrame([(1,), (4,)], "hadm_id bigint")
    known = spark.createDataFrame([(1,), (2,)], "hadm_id bigint")
    assert {r["hadm_id"]: r["found"] for r in knn.lookup(asked, known).collect()} == {1: True, 4: False}


def test_training_after_an_observation(spark):
    from casegraph.operators.report import observed

    counted, observation = observed(spark.range(10), "rows")
    counted.count()
    assert observation.get["rows"] == 10
    rng = np.random.default_rng(1)
    rows = [(i, [float(x)], int(x > 0)) for i, x in enumerate(rng.normal(size=200))]
    df = spark.createDataFrame(rows, "hadm_id bigint, features array<double>, label int")
    trained = mo.train(df, df)
    predictions = mo.score(trained.model, df)
    assert me.auc(predictions).first()["auc"] > 0.99


@pytest.mark.parametrize("few", [4096, 0])
def test_unusable_vectors_do_not_hide_others(spark, few):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(100, 4)))]
    bad = [(200, [float("nan"), 1.0, 1.0, 1.0]), (201, [float("inf")] * 4), (202, [None, 1.0, 1.0, 1.0]), (203, None)]
    schema = "id bigint, embedding array<double>"
    good, all_rows = spark.createDataFrame(rows, schema), spark.createDataFrame(rows + bad, schema)
    want = {tuple(r) for r in knn.nearest(good, good, 3, max_sent_queries=few).collect()}
    assert len(want) == 300
    assert {tuple(r) for r in knn.nearest(all_rows, all_rows, 3, max_sent_queries=few).collect()} == want
    assert {r["id"] for r in knn.unusable_vectors(all_rows).collect()} == {200, 201, 202, 203}
    short = spark.createDataFrame(rows + [(300, [1.0])], schema)
    with pytest.raises(Exception, match="expected 4 elements"):
        knn.nearest(good, short, 3, max_sent_queries=few).collect()


def test_vectors_of_another_length_are_an_error(spark):
    from casegraph.functions.vectors import mean_of_vectors

    df = spark.createDataFrame([([1.0, 2.0],), ([3.0, 4.0],), (None,)], "v array<double>")
    assert df.agg(mean_of_vectors(F.col("v"), 2).alias("m")).first()["m"] == [2.0, 3.0]
    with pytest.raises(Exception, match="expected 2 elements"):
        df.union(spark.createDataFrame([([1.0, 2.0, 3.0],)], "v array<double>")).agg(mean_of_vectors(F.col("v"), 2)).collect()
