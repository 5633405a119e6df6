import hashlib

import pytest
from pyspark.sql import functions as F

from casegraph.operators import ranking as rk


@pytest.mark.parametrize("partitions", [1, 4, 37])
def test_dense_index_is_an_ordered_bijection(spark, settings, partitions):
    settings("spark.sql.shuffle.partitions", str(partitions))
    df = spark.range(5000).select((F.col("id") * 7919 % 2003).alias("k")).union(spark.sql("SELECT CAST(NULL AS BIGINT)"))
    got = sorted((r["k"], r["idx"]) for r in rk.dense_index(df, "k").collect())
    keys = sorted({i * 7919 % 2003 for i in range(5000)})
    assert got == [(k, i) for i, k in enumerate(keys)]


def test_dense_index_orders_text_by_code_point(spark):
    words = ["b", "a", "B", "é", "UNKNOWN", "z", "0010", "10"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = {r["w"]: r["idx"] for r in rk.dense_index(df, "w").collect()}
    assert got == {w: i for i, w in enumerate(sorted(words))}


def test_dense_index_of_nothing(spark):
    assert rk.dense_index(spark.range(0), "id").count() == 0


@pytest.mark.parametrize("limit", [1000, 1])
def test_category_codes(spark, limit):
    df = spark.createDataFrame([(1, "b", None), (2, None, "x"), (3, "a", "X"), (4, "é", None)], "k int, c string, d string")
    got = {r["k"]: (r["c_enc"], r["d_enc"]) for r in rk.category_codes(df, ["c", "d"], max_categories=limit).collect()}
    assert got == {1: (2, 0), 2: (0, 2), 3: (1, 1), 4: (3, 0)}


def test_prefix_sums(spark):
    df = spark.range(1000).select((F.col("id") * 13 % 1000).alias("x"), (F.col("id") % 7).alias("n"))
    got = {r["x"]: r["before_n"] for r in rk.prefix_sums(df, "x", ["n"]).collect()}
    total, expected = 0, {}
    for r in df.orderBy("x").collect():
        expected[r["x"]] = total
        total += r["n"]
    assert got == expected


def hash_sorted(ids):
    return sorted(ids, key=lambda i: (hashlib.md5(f"{i}|42".encode()).hexdigest(), i))


@pytest.mark.parametrize("n", [0, 1, 7, 10, 333])
def test_exact_split(spark, n):
    got = {r["id"]: r["split"] for r in rk.split_exact(spark.range(n), "id").collect()}
    order = hash_sorted(range(n))
    a, b = int(0.8 * n), int(0.9 * n)
    expected = {i: "train" if p < a else "val" if p < b else "test" for p, i in enumerate(order)}
    assert got == expected


def test_hash_split_is_close_and_stable(spark):
    first = {r["id"]: r["split"] for r in rk.split_hash(spark.range(4000), "id").collect()}
    more = {r["id"]: r["split"] for r in rk.split_hash(spark.range(8000), "id").collect()}
    assert all(more[i] == s for i, s in first.items())
    assert 0.77 < sum(s == "train" for s in first.values()) / 4000 < 0.83


@pytest.mark.parametrize("positives", [0, 5, 400])
def test_undersample(spark, positives):
    df = spark.range(1000).withColumn("label", (F.col("id") < positives).cast("int"))
    got = {r["id"] for r in rk.undersample(df, "id", "label").collect()}
    negatives = hash_sorted(range(positives, 1000))[: 2 * positives]
    assert got == set(range(positives)) | set(negatives)


def test_first_in_split(spark):
    df = rk.split_exact(spark.range(50), "id")
    assert rk.first_in_split(df, "id").first()["id"] == min(hash_sorted(range(50))[45:])


@pytest.mark.parametrize("partitions", [1, 5])
def test_positions_number_repeated_rows_too(spark, settings, partitions):
    settings("spark.sql.shuffle.partitions", str(partitions))
    df = spark.range(3000).select((F.col("id") % 7 - 3).alias("k"), F.when(F.col("id") % 3 > 0, F.lit(9)).otherwise(F.col("id")).alias("v"))
    got = sorted((r["position"], r["k"], r["v"]) for r in rk.positions(df, ["k", "v"]).collect())
    assert [p for p, _, _ in got] == list(range(3000))
    assert [(k, v) for _, k, v in got] == sorted((i % 7 - 3, 9 if i % 3 else i) for i in range(3000))


def test_dropped_table_is_gone(spark):
    import os

    from casegraph.session import drop_table, materialize

    table = materialize(spark.range(3), "short-lived")
    folder = os.path.dirname(table.inputFiles()[0].removeprefix("file:"))
    assert os.path.isdir(folder) and drop_table(table) and not os.path.exists(folder)
    assert not drop_table(table) and not drop_table(spark.range(1))
