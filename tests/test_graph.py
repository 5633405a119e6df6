import numpy as np
import pytest
from pyspark.sql import functions as F

from casegraph.operators import features as fe
from casegraph.operators import graph as gr
from casegraph.operators import propagate as pr
from casegraph.operators import ranking as rk


@pytest.fixture(scope="module")
def small(spark):
    admissions = spark.createDataFrame(
        [(20, 2, 5.0, 1, "A"), (10, 1, -3.0, 0, None), (30, 9, 1.0, None, "B")],
        "hadm_id bigint, subject_id bigint, los_hours double, hospital_expire_flag int, admission_type string",
    ).withColumns({c: F.lit(None).cast("string") for c in ("admittime", "dischtime", "insurance", "marital_status", "race")})
    patients = spark.createDataFrame([(1, "F", 40), (2, "M", 60)], "subject_id bigint, gender string, anchor_age int")
    codes = "hadm_id bigint, icd_code string, icd_version int"
    diagnoses = spark.createDataFrame(
        [(10, "0010", 10), (10, "0010", 9), (10, "10", 9), (20, "0010", 9), (99, "X", 9), (20, None, 9)], codes
    )
    procedures = spark.createDataFrame([(10, "p", 9), (10, "p", 9), (20, "q", 10)], codes)
    drugs = spark.createDataFrame(
        [(10, "d", "t1"), (10, "d", "t2"), (10, "d", "t1"), (20, "d", None), (99, "e", "t1")],
        "hadm_id bigint, drug string, starttime string",
    )
    labs = spark.createDataFrame([(10, 1, 2.0), (10, 1, 4.0), (20, 1, 3.0), (20, 2, 7.0)], "hadm_id bigint, itemid int, valuenum double")
    return dict(
        admissions=admissions, patients=patients, diagnoses=diagnoses, procedures=procedures, prescriptions=drugs, labs=labs
    )


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_nodes_and_edges(small):
    g = gr.build_graph(**small)
    assert rows(g.nodes["Patient"]) == [(1, "F", 40), (2, "M", 60), (9, None, None)]
    assert rows(g.nodes["Diagnosis"]) == [("0010", 9), ("10", 9)]
    assert rows(g.edges["DIAGNOSED_WITH"]) == [(10, "0010"), (10, "10"), (20, "0010")]
    assert rows(g.edges["PRESCRIBED"]) == [(10, "d", "t1"), (10, "d", "t2")]
    assert rows(g.edges["HAS_PROCEDURE"]) == [(10, "p"), (20, "q")]
    assert rows(g.edges["HAS_LAB"])[0][:3] == (10, 1, 3.0)
    assert rows(g.nodes["LabTest"]) == [(1,), (2,)]
    versioned = gr.code_nodes(small["diagnoses"], small["admissions"], versioned=True)
    assert rows(versioned) == [("0010", 10), ("0010", 9), ("10", 9)]


def test_row_multiplicity_keeps_parallel_edges_and_missing_properties(small):
    g = gr.build_graph(**small, multiplicity="row")
    assert len(rows(g.edges["PRESCRIBED"])) == 4
    assert rows(g.edges["HAS_PROCEDURE"]) == [(10, "p"), (10, "p"), (20, "q")]
    with pytest.raises(ValueError):
        gr.fact_edges(small["diagnoses"], small["admissions"], "icd_code", multiplicity="other")


def test_validation(small):
    g = gr.build_graph(**small)
    report = {r["check"]: (r["count"], r["status"]) for r in gr.validate_graph(g).collect()}
    assert report[gr.NEGATIVE_STAYS] == (1, "WARNING: 1 found")
    assert report[gr.ORPHAN_DIAGNOSES] == (0, "OK")
    g.nodes["Diagnosis"] = gr.code_nodes(small["diagnoses"], None)
    g.edges["HAS_ADMISSION"] = g.edges["HAS_ADMISSION"].where("hadm_id <> 30")
    assert gr.orphan_diagnoses(g).first()["count"] == 1
    assert gr.orphan_admissions(g).first()["count"] == 1
    g.nodes["Patient"] = g.nodes["Patient"].union(g.nodes["Patient"].limit(1))
    assert {r["check"]: r["count"] for r in gr.unique_node_keys(g).collect()}["Duplicate Patient keys"] == 1


def test_reverse_edges(small):
    edges = gr.long_edges(gr.build_graph(**small).edges)
    both = gr.undirected(edges)
    assert both.count() == 2 * edges.count()
    back = both.where("edge_type LIKE 'rev_%'").select(
        F.regexp_replace("edge_type", "^rev_", "").alias("edge_type"), F.col("dst").alias("src"), F.col("src").alias("dst")
    )
    assert rows(back) == rows(edges)
    stats = {(r["kind"], r["type"]): r["n"] for r in gr.graph_stats(gr.build_graph(**small)).collect()}
    assert stats[("edge", "HAS_LAB")] == 3 and stats[("node", "Patient")] == 3
    degree = {(r["edge_type"], r["src"]): r["degree"] for r in gr.node_degree(edges).collect()}
    assert degree[("DIAGNOSED_WITH", "10")] == 2


def test_indexes_go_by_id_not_by_position(small):
    index = rk.dense_index(small["admissions"], "hadm_id")
    assert {r["hadm_id"]: r["idx"] for r in index.collect()} == {10: 0, 20: 1, 30: 2}
    patients = rk.dense_index(small["patients"], "subject_id")
    got = rows(gr.indexed_edges(small["admissions"], "subject_id", patients, "hadm_id", index))
    assert got == [(0, 0), (1, 1)]


def test_features(spark, small):
    counts = spark.createDataFrame([(20, 1, 2, 3)], "hadm_id bigint, n_nlp_symptoms bigint, n_nlp_diseases bigint, n_nlp_medications bigint")
    table = fe.admission_features(
        small["admissions"], small["patients"], small["diagnoses"], small["prescriptions"], small["procedures"], small["labs"], counts
    )
    got = {r["hadm_id"]: tuple(r)[1:] for r in table.collect()}
    assert got[10] == (40.0, 0.0, 2.0, 0.0, 0.0, 3.0, 1.0, 2.0, 1.0, 3.0, 0.0, 0.0, 0.0)
    assert got[20] == (60.0, 5.0, 0.0, 0.0, 0.0, 2.0, 1.0, 1.0, 2.0, 5.0, 1.0, 2.0, 3.0)
    assert got[30] == (0.0, 1.0, 1.0) + (0.0,) * 10
    assert {r["hadm_id"]: r["label"] for r in fe.labels(small["admissions"]).collect()} == {10: 0, 20: 1, 30: 0}


def test_scaler(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 2.0, 5.0), (3, 3.0, 5.0)], "hadm_id bigint, a double, c double")
    scaled = {r["hadm_id"]: (r["a"], r["c"]) for r in fe.fit_scaler(df, ["a", "c"]).transform(df).collect()}
    assert scaled[1] == (pytest.approx(-(1.5**0.5)), 0.0) and scaled[2] == (0.0, 0.0)
    train_only = fe.fit_scaler(df.where("hadm_id < 3"), ["a"])
    assert [r["features"] for r in train_only.vectors(df).orderBy("hadm_id").collect()] == [[-1.0], [1.0], [3.0]]
    assert fe.nonzero_fraction(df.withColumn("c", F.lit(0.0)), ["a", "c"]).first()["density"] == 0.5


def dense_layer(x, edges, weights, norms, relu=True):
    """One layer with plain arrays; ``edges`` are (source, type, target, src positions, dst positions)."""
    out = {}
    for target, own in x.items():
        messages = []
        for source, name, t, src, dst in edges:
            if t != target:
                continue
            mean = np.zeros_like(own)
            for i in range(len(own)):
                picked = [x[source][s] for s, d in zip(src, dst) if d == i]
                if picked:
                    mean[i] = np.mean(picked, axis=0)
            c = weights[name]
            messages.append(mean @ np.array(c.neighbour.weight) + np.array(c.neighbour.bias) + own @ np.array(c.root))
        value = np.max(messages, axis=0)
        if target in norms:
            n = norms[target]
            value = (value - n.mean) / np.sqrt(np.array(n.var) + n.eps) * n.gamma + n.beta
        out[target] = np.maximum(value, 0) if relu else value
    return out


def test_message_passing_equals_dense_computation(spark):
    rng = np.random.default_rng(7)
    dim, sizes = 3, {"Admission": 6, "Diagnosis": 4, "Patient": 3}
    x = {t: rng.normal(size=(n, dim)) for t, n in sizes.items()}
    links = [("Admission", "DIAGNOSED_WITH", "Diagnosis", [0, 0, 1, 2, 2, 5], [0, 1, 1, 2, 2, 1]), ("Patient", "HAS_ADMISSION", "Admission", [0, 0, 1], [0, 1, 2])]
    links += [(t, "rev_" + n, s, d, e) for s, n, t, e, d in links]

    def conv():
        return pr.Convolution(pr.Affine(rng.normal(size=(dim, dim)).tolist(), rng.normal(size=dim).tolist()), rng.normal(size=(dim, dim)).tolist())

    layers = [
        ({name: conv() for _, name, _, _, _ in links},
         {"Admission": pr.Norm(mean=[0.1] * dim, var=[2.0] * dim, gamma=[1.5] * dim, beta=[0.2] * dim)})
        for _ in range(2)
    ]
    head = pr.Affine(rng.normal(size=(dim, 2)).tolist(), [0.1, -0.1])
    expected = x
    for weights, norms in layers:
        expected = dense_layer(expected, links, weights, norms)
    logits = expected["Admission"] @ np.array(head.weight) + np.array(head.bias)

    nodes = {t: spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "id bigint, vector array<double>") for t, m in x.items()}
    edges = {(s, n, t): spark.createDataFrame(list(zip(e, d)), "src bigint, dst bigint") for s, n, t, e, d in links}
    got = {r["id"]: r["logits"] for r in pr.hetero_forward(nodes, edges, layers, head, dim).collect()}
    assert np.allclose([got[i] for i in range(sizes["Admission"])], logits)


def test_neighbourhood_features(spark):
    features = spark.createDataFrame([(1, [1.0, 0.0]), (2, [3.0, 2.0]), (3, [5.0, 5.0])], "hadm_id bigint, features array<double>")
    pairs = spark.createDataFrame([(1, 7), (2, 7), (2, 8)], "case bigint, item bigint")
    got = {r["hadm_id"]: r["features"] for r in pr.neighbourhood_features(features, {"d": pairs}, 2).collect()}
    assert got == {1: [1.0, 0.0, 2.0, 1.0], 2: [3.0, 2.0, 2.5, 1.5], 3: [5.0, 5.0, 0.0, 0.0]}


def test_indexes_of_edge_types_are_made_together(spark, monkeypatch):
    from workload import graph_queries as gq
    from workload.registry import QUERIES
    from workload.tables import Tables

    sizes, run = [], gq.at_once
    monkeypatch.setattr(gq, "at_once", lambda jobs: sizes.append(len(jobs)) or run(jobs))
    found = QUERIES["edge_index_all"](Tables(spark, "/root/testdata/sf0.001"))
    assert sizes == [6]
    ends = {r["edge_type"]: r for r in found.groupBy("edge_type").agg(F.min("dst_idx").alias("low"), F.count("src_idx").alias("n")).collect()}
    assert len(ends) == 5 and all(r["low"] == 0 and r["n"] > 0 for r in ends.values())
