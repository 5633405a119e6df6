import os
import re

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from casegraph.operators import graph as gr
from casegraph.plans import stages
from casegraph.sources import merged as mg


def table(tmp_path, **options):
    return mg.MergedTable(str(tmp_path / "table"), ("a", "b"), **{"buckets": 4} | options)


def frame(spark, rows):
    return spark.createDataFrame(rows, "a int, b string, old string, new string, k0 int")


def rows_of(spark, t):
    return sorted(map(tuple, mg.read_merged(spark, t).collect()))


def test_first_writer_stays_and_some_columns_follow_the_last(spark, tmp_path):
    t = table(tmp_path, overwrite=("new",))
    assert mg.read_merged(spark, t) is None
    mg.merge_rows(frame(spark, [(1, "x", "p", "q", 0), (1, "y", None, "q", 0), (None, "x", "p", "q", 0)]), t)
    mg.merge_rows(frame(spark, [(1, "x", "other", "r", 9), (1, "y", "other", None, 9), (2, "x", "s", "t", 1), (2, "x", "r", "u", 1)]), t, ["old"])
    want = [(1, "x", "p", "r", 0), (1, "y", None, None, 0), (2, "x", "r", "u", 1)]
    assert rows_of(spark, t) == want
    mg.merge_rows(frame(spark, [(1, "x", "other", "r", 9), (2, "x", "r", "u", 1)]), t)
    assert rows_of(spark, t) == want
    version = mg.manifest(spark, t).version
    mg.merge_rows(frame(spark, []), t)
    assert mg.manifest(spark, t).version == version and rows_of(spark, t) == want
    with pytest.raises(ValueError):
        mg.merge_rows(frame(spark, want).drop("old"), t)


def test_only_buckets_of_the_delta_are_rewritten(spark, tmp_path):
    t = table(tmp_path, buckets=16)
    first = mg.merge_rows(frame(spark, [(i, "x", "p", "q", 0) for i in range(200)]), t)
    second = mg.merge_rows(frame(spark, [(1000, "x", "p", "q", 0)]), t)
    changed = [b for b in first.files if first.files[b] != second.files[b]]
    assert len(first.files) == 16 and len(changed) == 1 and len(rows_of(spark, t)) == 201
    before = rows_of(spark, t)
    assert mg.vacuum(spark, t) == 1 and rows_of(spark, t) == before


def test_failed_and_concurrent_merges_change_nothing(spark, tmp_path, monkeypatch):
    t = table(tmp_path)
    mg.merge_rows(frame(spark, [(1, "x", "p", "q", 0)]), t)
    publish = mg._publish
    monkeypatch.setattr(mg, "_publish", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        mg.merge_rows(frame(spark, [(2, "x", "p", "q", 0)]), t)
    assert len(rows_of(spark, t)) == 1

    def late(session, folder, new):  # another merge publishes first
        monkeypatch.setattr(mg, "_publish", publish)
        mg.merge_rows(frame(spark, [(3, "x", "p", "q", 0)]), t)
        publish(session, folder, new)

    monkeypatch.setattr(mg, "_publish", late)
    with pytest.raises(RuntimeError, match="another merge"):
        mg.merge_rows(frame(spark, [(4, "x", "p", "q", 0)]), t)
    assert [r[0] for r in rows_of(spark, t)] == [1, 3]
    assert not [n for n in os.listdir(tmp_path / "table" / "manifests") if n.endswith(".draft")]


def test_two_batches_are_one_graph(spark, tmp_path):
    from workload.graph_queries import graph
    from workload.tables import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    folder = str(tmp_path / "graph")
    for odd in (0, 1):
        batch = t.admissions.where(F.col("hadm_id") % 2 == odd)
        part = gr.build_graph(batch, t.patients, t.diagnoses, t.procedures, t.prescriptions, t.labs, t.entities)
        stages.merge_graph(part, folder, 4)
    whole, merged = graph(t), stages.read_graph(spark, folder)
    for kind in ("nodes", "edges"):
        for name, want in getattr(whole, kind).items():
            got = getattr(merged, kind)[name].select(*want.columns)
            if name in ("Diagnosis", "Procedure"):  # the version is the first batch's
                got, want = got.select("icd_code"), want.select("icd_code")
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), name


def test_a_delta_is_computed_once_and_shuffled_once(spark, tmp_path, monkeypatch):
    t, seen, plans = table(tmp_path, overwrite=("new",)), spark.sparkContext.accumulator(0), []

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    def written(self, path, write=DataFrameWriter.parquet, **options):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return write(self, path, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", written)
    for n in (100, 150):
        delta = frame(spark, [(i, "x", "p", f"q{n}", 0) for i in range(n)])
        seen.value = 0
        mg.merge_rows(delta.mapInArrow(count, delta.schema), t)
        assert seen.value == n
    assert [len(re.findall(r" Exchange ", p)) for p in plans if "bucket" in p] == [1, 1]
    assert rows_of(spark, t) == [(i, "x", "p", "q150", 0) for i in range(150)]


def test_shuffles_of_a_merged_graph_go_with_each_table(spark, tmp_path, monkeypatch):
    name, values = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", []
    monkeypatch.setattr(stages, "merge_rows", lambda rows, t: values.append(spark.conf.get(name)))
    before = spark.conf.get(name)
    nodes = {n: frame(spark, []) for n in ("Patient", "Admission")}
    stages.merge_graph(gr.CaseGraph(nodes, {}), str(tmp_path))
    assert values == ["true", "true"] and spark.conf.get(name) == before
