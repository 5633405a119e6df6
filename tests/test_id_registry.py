import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from casegraph.operators import graph as gr
from casegraph.operators import id_registry as ids
from casegraph.sources import merged as mg
from casegraph.sources import sinks


def keys(spark, values, of="string"):
    return spark.createDataFrame([(v,) for v in values], f"k {of}")


def places(registry):
    return {r["k"]: (r["idx"], r["batch"]) for r in registry.collect()}


def test_positions_stay_and_new_keys_follow(spark, tmp_path):
    folder = str(tmp_path / "index")
    assert ids.read_index(spark, "k", folder) is None
    assert ids.extend_index(keys(spark, [None, None]), "k", folder) is None
    first = places(ids.extend_index(keys(spark, ["m", "c", "m", None, ""]), "k", folder, 4))
    assert first == {"": (0, 1), "c": (1, 1), "m": (2, 1)}
    second = places(ids.extend_index(keys(spark, ["z", "a", "m", "a", None]), "k", folder, 4))
    assert second == first | {"a": (3, 2), "z": (4, 2)}
    for again in (["a", "m"], [], [None]):
        assert places(ids.extend_index(keys(spark, again), "k", folder)) == second
    third = places(ids.extend_index(keys(spark, [f"b{i}" for i in range(300)] * 2), "k", folder))
    assert {k: third[k] for k in second} == second
    assert sorted(i for i, _ in third.values()) == list(range(305))


def test_registry_serves_edges_and_casts_later_batches(spark, tmp_path):
    folder = str(tmp_path / "index")
    ids.extend_index(keys(spark, [30, 10], "bigint"), "k", folder, 2)
    registry = ids.extend_index(keys(spark, [20, 10], "int"), "k", folder)
    assert {r["k"]: r["idx"] for r in registry.collect()} == {10: 0, 30: 1, 20: 2}
    edges = spark.createDataFrame([(10, 20), (30, 10), (10, 99)], "k bigint, to bigint")
    other = registry.withColumnRenamed("k", "to")
    assert sorted(map(tuple, gr.indexed_edges(edges, "k", registry, "to", other).collect())) == [(0, 2), (1, 0)]
    with pytest.raises(ValueError):
        ids.extend_index(spark.range(1).toDF("idx"), "idx", folder)


def test_an_extension_in_between_is_an_error(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "index")
    ids.extend_index(keys(spark, ["a"]), "k", folder, 2)
    dense = ids.dense_index

    def late(new, key):
        monkeypatch.setattr(ids, "dense_index", dense)
        ids.extend_index(keys(spark, ["c"]), "k", folder)
        return dense(new, key)

    monkeypatch.setattr(ids, "dense_index", late)
    with pytest.raises(RuntimeError):
        ids.extend_index(keys(spark, ["b"]), "k", folder)
    assert places(ids.read_index(spark, "k", folder)) == {"a": (0, 1), "c": (1, 2)}
    assert places(ids.extend_index(keys(spark, ["b"]), "k", folder))["b"] == (2, 3)


def test_case_results_are_found_in_one_row_group(spark, tmp_path, settings):
    path = str(tmp_path / "cases")
    assert sinks.read_cases(spark, path, [1]) is None
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", "65536")
    try:
        first = spark.range(20_000).select(F.col("id").alias("hadm_id"), F.sha2(F.col("id").cast("string"), 512).alias("answer"))
        sinks.merge_case_results(first, path, rows_per_bucket=5_000)
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")
    assert mg.manifest(spark, mg.MergedTable(path, ("hadm_id",))).buckets == 4
    found = sinks.read_cases(spark, path, [777])
    assert found.count() == 1 and len(found.inputFiles()) == 1
    assert "PushedFilters: [IsNotNull(hadm_id), EqualTo(hadm_id,777)]" in found._jdf.queryExecution().toString()
    groups = [pq.ParquetFile(f).metadata for f in glob.glob(found.inputFiles()[0].removeprefix("file:").replace("%20", " "))]
    ranges = [m.row_group(i).column(0).statistics for m in groups for i in range(m.num_row_groups)]
    assert len(ranges) > 3 and sum(r.min <= 777 <= r.max for r in ranges) == 1
    # a second batch replaces known cases and adds new ones
    again = spark.createDataFrame([(777, None), (30_000, "new"), (None, "lost")], "hadm_id bigint, answer string")
    sinks.merge_case_results(again, path)
    assert sinks.read_cases(spark, path).count() == 20_001
    got = {r["hadm_id"]: r["answer"] for r in sinks.read_cases(spark, path, [777, 30_000, 40_000, None]).collect()}
    assert got == {777: None, 30_000: "new"}
    assert sinks.read_cases(spark, path, []).count() == 0
