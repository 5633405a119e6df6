import zlib

import numpy as np
import pyarrow as pa

from casegraph.llm import quality_classifier as qc
from casegraph.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    good = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = QUERIES["op10_quality_classifier"](spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    own = [(good[r.doc_id], r.predicted, r.score) for r in rows if r.held_out and r.doc_id in good]
    y, p, s = map(np.array, zip(*own))
    ranks = np.argsort(np.argsort(s))
    auc = (ranks[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() - 1) / 2) / ((y == 1).sum() * (y == 0).sum())
    print("accuracy", (y == p).mean(), "share of label 1", y.mean(), "auc", auc)
    assert (y == p).mean() > 0.95


def test_pairs_in_linear_time():
    rng = np.random.default_rng(3)
    machine = qc.Machine(np.sort(rng.normal(size=(13, 4)), axis=1), 8, 0.3, rng.normal(size=8 + 65), rng.normal(size=(8 + 65, 3)))
    column = pa.array(["One two two three.", "", None, "A | b ### c\nA | b ### c"])
    structure, text, bucket, weight = qc.describe(column, 8)
    for i, got in enumerate(machine.score(column)["score"]):
        x = np.zeros(8 + 65)
        x[bucket[text == i]] = weight[text == i]
        x[machine.features(structure)[i]] = 1
        total = machine.bias + x @ machine.weights
        total += sum(machine.vectors[a] @ machine.vectors[b] * x[a] * x[b] for a in range(len(x)) for b in range(a))
        assert np.isclose(got, 1 / (1 + np.exp(-total)))


def test_odd_rows(spark):
    rows = [(i, "Some good words, in a row." if i % 4 else "### $$$ %%% bad", "x") for i in range(300)]
    rows += [(500, None, "y"), (501, "", None), (None, "Good words, in a row.", ""), (3, "Again words.", ""), (502, "bad ### " * 50_000, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, predicted string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(200)] + [(210, None), (None, 1)], "doc_id long, quality int")
    machine = qc.fit(docs, labels, ~qc.held_out())
    got = qc.score(docs, machine).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == int(r.doc_id % 4 != 0) for r in got if r.doc_id is not None and r.doc_id < 300)
    assert qc.score(docs.limit(0), machine).count() == 0
    assert {r.score for r in qc.score(docs, qc.fit(docs, labels.limit(0), ~qc.held_out())).collect()} == {0.5}
