"""Shapes of physical plans, without broadcasts, as they would be on large tables."""

import re

import pytest
from pyspark.sql import functions as F

from casegraph.operators import aggregates as ag
from casegraph.operators import cohort as co
from casegraph.operators import entities as en
from casegraph.operators import graph as gr
from casegraph.operators import knn
from casegraph.operators import propagate as pr
from workload.tables import Tables

SF = "/root/testdata/sf0.001"


@pytest.fixture
def plan(settings):
    settings("spark.sql.autoBroadcastJoinThreshold", "-1")
    return lambda df: re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


def test_scan_reads_only_its_columns_and_filters_there(spark, plan):
    tables = Tables(spark, SF)
    text = plan(co.cohort_ids(tables.scan("lineitem", "l_orderkey", "l_shipdate"), "l_orderkey"))
    assert "ReadSchema: struct<l_orderkey:bigint>" in text and "PushedFilters: [IsNotNull(l_orderkey)]" in text


def test_first_row_is_picked_before_the_shuffle(spark, plan):
    text = plan(co.first_per_key(Tables(spark, SF).labs, ["hadm_id", "itemid"]))
    assert re.search(r"WindowGroupLimit .*Final[\s\S]*Exchange hashpartitioning\(hadm_id, itemid[\s\S]*WindowGroupLimit .*Partial", text)


def test_edges_are_distinct_before_they_meet_the_admissions(spark, plan):
    tables = Tables(spark, SF)
    text = plan(gr.fact_edges(tables.prescriptions, tables.admissions_raw, "drug", ("starttime",)))
    assert "LeftSemi" in text
    assert re.search(r"Exchange hashpartitioning\(hadm_id, \d+\)[\s\S]*HashAggregate\(keys=\[hadm_id, drug, starttime\]", text)


def test_notes_of_one_case_are_not_bound_to_one_task(spark, plan):
    tables = Tables(spark, SF)
    notes = en.select_notes(tables.notes, tables.admissions_raw)
    text = plan(en.dictionary_mentions(notes, tables.dictionary))
    assert re.search(r"hashpartitioning\(hadm_id, term, kind", text)
    assert re.search(r"hashpartitioning\(hadm_id, _group", text)


def test_distinct_count_shuffles_pairs_first(spark, plan):
    text = plan(ag.distinct_per_key(Tables(spark, SF).prescriptions, ["hadm_id"], "drug"))
    assert re.search(r"hashpartitioning\(hadm_id, \d+[\s\S]*hashpartitioning\(hadm_id, drug", text)


def test_vector_mean_is_a_hash_aggregate_with_partial_sums(spark, plan):
    tables = Tables(spark, SF)
    edges = tables.scan("lineitem", "l_orderkey", "l_suppkey").toDF("src", "dst")
    text = plan(pr.neighbour_means(edges, tables.embeddings.toDF("id", "vector"), 64))
    assert "HashAggregate(keys=[dst]" in text and "partial_sum" in text
    assert "ObjectHashAggregate" not in text and "SortAggregate" not in text


def test_neighbours_are_limited_before_the_shuffle(spark, plan):
    tables = Tables(spark, SF)
    for limit in (4096, 0):
        text = plan(knn.nearest(tables.embeddings, tables.embeddings, 5, "hadm_id", max_sent_queries=limit))
        assert re.search(r"WindowGroupLimit .*Final[\s\S]*WindowGroupLimit .*Partial", text)
        assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_one_case_with_most_notes(spark, settings):
    """Results do not depend on how the rows of a hot case are spread."""
    settings("spark.sql.autoBroadcastJoinThreshold", "-1")
    notes = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, F.lit(1)).otherwise(F.col("id")).alias("hadm_id"),
        F.concat(F.lit("the word "), (F.col("id") % 40).cast("string")).alias("text"),
    )
    cases = spark.range(1500).toDF("hadm_id")
    dictionary = spark.createDataFrame([("the", "symptom"), ("word 7", "disease")], "term string, kind string")
    found = en.dictionary_mentions(en.select_notes(notes, cases), dictionary).toPandas()
    data = notes.toPandas()
    data = data[data.hadm_id < 1500]
    assert found[found.term == "the"].set_index("hadm_id")["n"].to_dict() == data.groupby("hadm_id").size().to_dict()
    sevens = data[data.text == "the word 7"].groupby("hadm_id").size().to_dict()
    assert found[found.term == "word 7"].set_index("hadm_id")["n"].to_dict() == sevens


@pytest.fixture
def few_cases(spark):
    """Cases with rows that come twice, rows without a case, rows of unknown cases, and a case with most rows."""
    admissions = spark.createDataFrame(
        [(c, s, t) for c, s in ((1, 1), (2, 1), (3, None), (None, 2)) for t in ("A", None)], "hadm_id bigint, subject_id bigint, race string"
    ).withColumns({c: F.lit(None).cast("string") for c in gr.ADMISSION_PROPERTIES if c != "race"})
    patients = spark.createDataFrame([(1, "F", 40), (2, "M", 60)], "subject_id bigint, gender string, anchor_age int")
    facts = spark.range(0, 600, 1, 4).select(
        F.expr("CASE WHEN id % 10 > 3 THEN 1 WHEN id % 10 > 0 THEN id % 10 + 1 END").alias("hadm_id"),
        F.expr("CASE WHEN id % 7 > 0 THEN concat('c', id % 7) END").alias("item"),
        F.expr("CASE WHEN id % 11 > 0 THEN cast(id % 11 AS int) END").alias("number"),
        F.expr("CASE WHEN id % 13 > 0 THEN cast(id AS double) END").alias("valuenum"),
    )
    codes = facts.select("hadm_id", F.col("item").alias("icd_code"), F.col("number").alias("icd_version"))
    return dict(
        admissions=admissions, patients=patients, diagnoses=codes, procedures=codes.where("icd_version > 5"),
        prescriptions=facts.select("hadm_id", F.col("item").alias("drug"), F.col("number").alias("starttime")),
        labs=facts.select("hadm_id", F.col("number").alias("itemid"), "valuenum"),
    )


def test_a_graph_shuffles_its_facts_once(plan, few_cases):
    g = gr.build_graph(**few_cases)
    for edge in ("DIAGNOSED_WITH", "HAS_PROCEDURE", "PRESCRIBED", "HAS_LAB"):
        # the facts and the ids of the admissions
        assert re.findall(r"Exchange hashpartitioning\((.*), \d+\)", plan(g.edges[edge])) == ["hadm_id", "hadm_id"], edge
    for node in ("Diagnosis", "Procedure"):
        # and the codes, combined before
        assert re.findall(r"Exchange hashpartitioning\((.*), \d+\)", plan(g.nodes[node])) == ["icd_code", "hadm_id", "hadm_id"], node


def test_nodes_and_edges_share_the_shuffle_of_codes(spark, settings, few_cases):
    settings("spark.sql.autoBroadcastJoinThreshold", "-1")
    t = Tables(spark, SF)
    g = gr.build_graph(**(few_cases | {"admissions": t.admissions, "diagnoses": gr.by_admission(t.diagnoses_raw).distinct()}))
    stats = gr.graph_stats(gr.CaseGraph({"Diagnosis": g.nodes["Diagnosis"]}, {"DIAGNOSED_WITH": g.edges["DIAGNOSED_WITH"]}))
    stats.collect()
    final = stats._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert re.search(r"ReusedExchange \[hadm_id\S*, icd_code\S*, icd_version\S*\], Exchange hashpartitioning\(hadm_id", final)


def test_counted_admissions_are_shuffled_without_their_properties(plan, few_cases):
    text = plan(gr.graph_stats(gr.CaseGraph({"Admission": gr.admission_nodes(few_cases["admissions"])}, {})))
    assert "race" not in text.split("hashpartitioning(hadm_id")[0] and "keys=[hadm_id], functions=[]" in text


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_a_graph_is_that_of_its_rows(settings, few_cases, threshold):
    settings("spark.sql.autoBroadcastJoinThreshold", threshold)
    g = gr.build_graph(**few_cases)
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    known = lambda df, *columns: {
        tuple(r[c] for c in columns) for r in df.collect() if r["hadm_id"] in (1, 2, 3) and None not in [r[c] for c in columns]
    }
    diagnoses = known(few_cases["diagnoses"], "hadm_id", "icd_code")
    assert rows(g.edges["DIAGNOSED_WITH"]) == sorted(diagnoses, key=str)
    assert rows(g.edges["PRESCRIBED"]) == sorted(known(few_cases["prescriptions"], "hadm_id", "drug", "starttime"), key=str)
    assert {tuple(r)[:2] for r in rows(g.edges["HAS_LAB"])} == known(few_cases["labs"], "hadm_id", "itemid")
    values = [r["valuenum"] for r in few_cases["labs"].where("hadm_id = 1 AND itemid = 2 AND valuenum IS NOT NULL").collect()]
    mean = g.edges["HAS_LAB"].where("hadm_id = 1 AND itemid = 2").first()["mean_value"]
    assert mean == pytest.approx(sum(values) / len(values))
    lowest = {code: min(v for _, c, v in known(few_cases["diagnoses"], "hadm_id", "icd_code", "icd_version") if c == code) for _, code in diagnoses}
    assert rows(g.nodes["Diagnosis"]) == sorted(lowest.items())
    # the first in the order of the properties: nulls come first
    assert {(r["hadm_id"], r["race"]) for r in g.nodes["Admission"].collect()} == {(1, None), (2, None), (3, None), (None, None)}


def test_nan_is_missing_as_before(spark):
    facts = spark.createDataFrame([(1, float("nan"), "t"), (1, 2.0, "t"), (1, None, "t"), (1, 3.0, None)], "hadm_id bigint, dose double, at string")
    edges = gr.fact_edges(facts, spark.range(3).toDF("hadm_id"), "dose", ("at",))
    assert [tuple(r) for r in edges.collect()] == [(1, 2.0, "t")]
