"""Files to explained cases, sinks, and incremental extraction."""

import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from casegraph.operators import context as cx
from casegraph.operators import entities as en
from casegraph.plans import stages
from casegraph.sources import readers, sinks
from casegraph.sources.schemas import SCHEMAS, DataLayout
from casegraph.streaming import incremental


def write(folder, name, text):
    path = os.path.join(str(folder), name)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_csv_notes(spark, tmp_path):
    path = write(tmp_path, "n.csv", 'note,hadm_id,text\na,1.0,"two\nlines, ""quoted"""\nb,,orphan\nc,2,NA\nd,9007199254740993,big\n')
    got = [tuple(r) for r in readers.scan_csv(spark, path, SCHEMAS["notes"], ["NA"], multi_line=True).collect()]
    assert got == [(1, 'two\nlines, "quoted"'), (None, "orphan"), (2, None), (9007199254740993, "big")]


def test_csv_codes_keep_leading_zeros(spark, tmp_path):
    path = write(tmp_path, "d.csv", "subject_id,hadm_id,seq_num,icd_code,icd_version\n1,1,1,0010,9\n1,1,2,10,10\n1,1,3,,9\n")
    assert [r["icd_code"] for r in readers.scan_csv(spark, path, SCHEMAS["diagnoses"]).collect()] == ["0010", "10", None]


def test_csv_bad_values(spark, tmp_path):
    path = write(tmp_path, "l.csv", "hadm_id,itemid,charttime,valuenum\n1,2,2020-01-01 00:00:00,NaN\n1,2,xx,4\n1,x,,5\n")
    rows = readers.scan_csv(spark, path, SCHEMAS["labevents"], on_error="null").collect()
    assert [r["valuenum"] for r in rows] == [None, 4.0, 5.0]
    assert rows[1]["charttime"] is None and rows[2]["itemid"] is None
    with pytest.raises(Exception, match="not a timestamp|bad value"):
        readers.scan_csv(spark, path, SCHEMAS["labevents"]).collect()
    with pytest.raises(ValueError):
        readers.scan_csv(spark, path, SCHEMAS["notes"])


def test_sinks(spark, tmp_path):
    sets = spark.createDataFrame([(1, ["a"], [], ["m"])], "hadm_id bigint, symptoms array<string>, diseases array<string>, medications array<string>")
    sinks.write_entities(sets, str(tmp_path / "e"))
    assert readers.scan_entities(spark, str(tmp_path / "e")).collect() == sets.collect()
    for fmt in ("csv", "parquet", "json"):
        sinks.write_table(spark.range(5), str(tmp_path / fmt), fmt)
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 5
    results = spark.range(30).select(F.col("id").alias("hadm_id"), F.lit("é\nx").alias("justification"))
    sinks.write_case_results(results, str(tmp_path / "r"), buckets=4)
    assert [r["justification"] for r in sinks.read_case_result(spark, str(tmp_path / "r"), 17, buckets=4).collect()] == ["é\nx"]
    sinks.write_report(spark.range(2), str(tmp_path / "rep"))
    assert len([f for f in os.listdir(tmp_path / "rep") if f.endswith(".json")]) == 1


def clinic(folder, n=60):
    """A small hospital: admission i of patient i % 20, most with a note, some with flaws."""
    adm = ["subject_id,hadm_id,admittime,dischtime,admission_type,insurance,marital_status,race,hospital_expire_flag"]
    pat = ["subject_id,gender,anchor_age"] + [f"{s},{'FM'[s % 2]},{16 + s * 3}" for s in range(20)]
    codes = {k: ["subject_id,hadm_id,seq_num,icd_code,icd_version"] for k in ("diagnoses", "procedures")}
    labs, drugs, notes = ["hadm_id,itemid,charttime,valuenum"], ["hadm_id,drug,starttime"], ["hadm_id,text"]
    for i in range(n):
        day = "2020-01-0%d" % (1 if i == 7 else 3)  # admission 7 ends before it starts
        died = int(i % 3 == 0)
        adm.append(f"{i % 20},{i},2020-01-02 00:00:00,{day} 06:15:00,{'URGENT' if died else 'ELECTIVE'},{'' if i % 5 else 'Medicare'},,X,{died}")
        for j in range(i % 4):
            codes["diagnoses"].append(f"{i % 20},{i},{j},00{(i + j) % 6},{9 + j % 2}")
            codes["procedures"].append(f"{i % 20},{i},{j},p{j % 2},9")
            labs.append(f"{i},{j},2020-01-02 0{j}:00:00,{'' if j == 2 else 10.5 * (1 + died) + j}")
            drugs.append(f"{i},drug{(i * j) % 5},{'' if j == 1 else '2020-01-02 00:00:00'}")
        if i % 10:
            notes.append(f'{i}.0,"{"fever and flu" if died else "cough"}, took aspirin"')
    adm.append(adm[1])
    layout = DataLayout(str(folder), str(folder), str(folder / "out"))
    for table, lines in [("admissions", adm), ("patients", pat), ("labevents", labs), ("prescriptions", drugs), ("notes", notes), *codes.items()]:
        write(folder, layout.files[table], "\n".join(lines) + "\n")
    return layout


TERMS = [("fever", "symptom"), ("cough", "symptom"), ("flu", "disease"), ("aspirin", "medication")]


def test_files_to_explained_cases(spark, tmp_path):
    layout = clinic(tmp_path)
    raw = stages.load_tables(spark, layout)
    cohort, selection = stages.extract_cohort(raw)
    counts = {r["table"]: (r["before"], r["after"]) for r in selection.collect()}
    assert counts["admissions"] == (61, 54) and counts["patients"] == (20, 18)
    cleaned, report = stages.clean_tables(cohort)
    tables = stages.written(cleaned)
    steps = {(r["table"], r["step"]): (r["before"], r["after"]) for r in report.collect()}
    assert all(r["before"] == r["after"] + r["dropped"] for r in report.collect())
    assert steps[("admissions", "interval")] == (54, 53)
    assert tables.patients.where("anchor_age < 18").count() == 0
    assert tables.admissions.where("los_hours <> 30.25").count() == 0
    strict, _ = stages.clean_tables(cohort, propagate_patient_filter=True)
    assert strict.admissions.count() <= tables.admissions.count()
    assert tables.prescriptions.where("hadm_id % 10 = 0 OR hadm_id = 7").count() == 0

    dictionary = spark.createDataFrame(TERMS, "term string, kind string")
    entities = stages.extract_entities(tables, lambda notes: en.dictionary_mentions(notes, dictionary))
    assert tuple(entities.where("hadm_id = 3").first()) == (3, ["fever"], ["flu"], ["aspirin"])
    assert stages.extract_entities(tables, lambda n: en.dictionary_mentions(n, dictionary), done=tables.admissions).count() == 0

    graph, checks = stages.build_case_graph(tables, entities)
    assert {r["status"] for r in checks.collect()} == {"OK"}
    training = stages.build_training_graph(tables, entities)
    assert training.admissions.count() == 53
    assert {r["split"]: r["count"] for r in training.admissions.groupBy("split").count().collect()} == {"train": 42, "val": 5, "test": 6}
    assert training.edges["PRESCRIBED"].count() == tables.prescriptions.count()
    odd = replace(tables, admissions=tables.admissions.where("hadm_id % 2 = 1"))
    early = stages.build_training_graph(odd, entities, index_folder=str(tmp_path / "index"))
    places = {r["hadm_id"]: r["idx"] for r in early.admissions.collect()}
    drugs = {r["drug"]: r["idx"] for r in early.vocabularies["Medication"].collect()}
    late = stages.build_training_graph(tables, entities, index_folder=str(tmp_path / "index"))
    then = {r["hadm_id"]: r["idx"] for r in late.admissions.collect()}
    assert places.items() <= then.items() and sorted(then.values()) == list(range(53))
    assert drugs.items() <= {r["drug"]: r["idx"] for r in late.vocabularies["Medication"].collect()}.items()
    assert late.admissions.columns == training.admissions.columns
    assert {t: e.count() for t, e in late.edges.items()} == {t: e.count() for t, e in training.edges.items()}
    result = stages.train_and_evaluate(training)
    assert {r["metric"] for r in result.report.collect()} == {"auc", "f1", "precision", "recall"}

    embeddings = training.admissions.select("hadm_id", F.col("features").alias("embedding"))
    prompt = stages.explain_cases(graph, embeddings, result.predictions, k=3).collect()
    assert len(prompt) == 1 and len(prompt[0]["similar_patients"]) == 3
    assert prompt[0]["prediction"] in prompt[0]["user_prompt"]
    assert "[Similar Patient 3] — Outcome: " in prompt[0]["user_prompt"]
    place = result.embeddings.where(F.col("hadm_id") == prompt[0]["hadm_id"]).first()["idx"]
    by_place = stages.explain_cases(graph, result.embeddings, result.predictions, spark.createDataFrame([(place,)], "idx bigint"), k=3)
    assert [r["hadm_id"] for r in by_place.collect()] == [prompt[0]["hadm_id"]]
    with pytest.raises(ValueError):
        stages.explain_cases(graph, result.embeddings, result.predictions, spark.createDataFrame([(10**6,)], "idx bigint"))
    assert {tuple(r["features"]) for v in training.vocabularies.values() for r in v.collect()} == {(1.0,)}

    cases = cx.case_results(by_place)
    stages.save_tables(tables, layout, "cleaned")
    stages.save_results(layout, {"cleaning": report}, entities, result.embeddings, result.predictions, cases)
    again = stages.saved_tables(spark, layout, "cleaned")
    assert sorted(map(str, again.admissions.collect())) == sorted(map(str, tables.admissions.collect()))
    assert readers.scan_entities(spark, layout.output("entities")).count() == entities.count()
    assert spark.read.json(layout.output("reports/cleaning")).count() == report.count()
    assert spark.read.parquet(layout.output("embeddings")).count() == 53
    assert spark.read.parquet(layout.output("predictions")).count() == result.predictions.count()
    assert sinks.read_case_result(spark, layout.output("cases"), prompt[0]["hadm_id"]).count() == 1
    unknown = spark.createDataFrame([(999_999,)], "hadm_id bigint")
    with pytest.raises(ValueError):
        stages.explain_cases(graph, embeddings, result.predictions, unknown)


def test_context_text(spark, tmp_path):
    schema = (
        "hadm_id bigint, admission_type string, insurance string, los_hours double, died int, nlp_symptoms array<string>, "
        "nlp_diseases array<string>, nlp_medications array<string>, diagnoses array<string>, medications array<string>, "
        "procedures array<string>, lab_results array<struct<item: int, mean: double>>"
    )
    profiles = spark.createDataFrame(
        [
            (1, "URGENT", None, 12.25, 0, ["fever", "pain"], None, None, ["0010", "I10"], [], ["p"], []),
            (2, "X", None, None, 1, None, None, None, [], ["d1", "d2"], [], []),
        ],
        schema,
    )
    queries = spark.createDataFrame([(1,), (3,)], "hadm_id bigint")
    neighbours = spark.createDataFrame([(1, 2, 0.5, 1), (1, 1, 0.7, 2)], "query_id bigint, neighbor_id bigint, distance double, rank int")
    got = {r["hadm_id"]: r for r in cx.case_context(queries, neighbours, profiles).collect()}
    assert got[1]["context"].split("\n") == [
        "=== PATIENT QUERY ===", "Admission type : URGENT", "Length of stay : 12.2 hours", "Diagnoses      : 0010, I10",
        "Medications    : None", "Procedures     : p", "NLP Symptoms   : fever, pain", "NLP Diseases   : None", "",
        "=== SIMILAR PAST PATIENTS (retrieved by GNN embeddings) ===",
        "", "[Similar Patient 1] — Outcome: DIED", "  Diagnoses  : None", "  Medications: d1, d2", "  Procedures : None", "  LOS (hrs)  : N/A",
        "", "[Similar Patient 2] — Outcome: SURVIVED", "  Diagnoses  : 0010, I10", "  Medications: None", "  Procedures : p", "  LOS (hrs)  : 12.2",
    ]
    assert got[1]["similar_patients"] == [2, 1]
    assert "Admission type : N/A" in got[3]["context"] and got[3]["similar_patients"] == []
    prompts = cx.case_prompts(cx.case_context(queries, neighbours, profiles), spark.createDataFrame([(1, 0.8)], "hadm_id bigint, prob double"))
    answers = spark.createDataFrame([(1, "because")], "hadm_id bigint, justification string")
    record = {r["hadm_id"]: r for r in cx.case_results(prompts, answers).collect()}[1]
    assert record["prediction"] == "HIGH MORTALITY RISK (confidence: 80.0%)" and record["justification"] == "because"


def test_incremental_extraction(spark, tmp_path):
    dictionary = spark.createDataFrame(TERMS, "term string, kind string")
    inbox, store, checkpoint = (str(tmp_path / n) for n in ("inbox", "store", "checkpoint"))
    seen = []

    def extract(notes):
        seen.append(notes.count())
        return en.dictionary_mentions(notes, dictionary)

    def run(per_batch=None):
        incremental.start_extraction(spark, inbox, store, checkpoint, extract, per_batch).awaitTermination()
        return {r["hadm_id"]: tuple(r)[1:] for r in incremental.read_entities(spark, store).collect()}

    def arrive(rows):
        spark.createDataFrame(rows, incremental.NOTE_SCHEMA).coalesce(1).write.mode("append").parquet(inbox)

    arrive([(1, "fever"), (2, "cough cough"), (2, "cough cough"), (None, "x"), (4, None)])
    assert run() == {1: (["fever"], [], []), 2: (["cough"], [], [])}
    assert run() and seen == [2]
    arrive([(1, "flu"), (2, "cough cough"), (3, "aspirin")])
    arrive([(1, "fever")])
    final = run(per_batch=1)
    assert sum(seen) == 4  # repeated notes are not processed again
    everything = spark.read.parquet(inbox).where("hadm_id IS NOT NULL AND text IS NOT NULL")
    batch = {r["hadm_id"]: tuple(r)[1:] for r in en.entity_sets(en.dictionary_mentions(everything, dictionary)).collect()}
    assert final == batch
    assert incremental.read_done(spark, store).count() == 4


def test_stream_forgets_nothing_and_reads_no_history(spark, tmp_path):
    """A batch that fails is replayed; later batches know its notes though what it stored is gone."""
    import shutil

    dictionary = spark.createDataFrame(TERMS, "term string, kind string")
    inbox, store, checkpoint = (str(tmp_path / n) for n in ("inbox", "store", "checkpoint"))
    seen, fail = [], [True]

    def extract(notes):
        if fail and fail.pop():
            raise RuntimeError("lost")
        seen.append(sorted(r["hadm_id"] for r in notes.collect()))
        return en.dictionary_mentions(notes, dictionary)

    def arrive(rows):
        spark.createDataFrame(rows, incremental.NOTE_SCHEMA).coalesce(1).write.mode("append").parquet(inbox)

    def run():
        incremental.start_extraction(spark, inbox, store, checkpoint, extract).awaitTermination()

    arrive([(1, "fever"), (2, "cough"), (1, "fever")])
    with pytest.raises(Exception, match="lost"):
        run()
    run()
    assert seen == [[1, 2]]
    shutil.move(f"{store}/done", f"{store}/moved")
    arrive([(1, "fever"), (3, "flu"), (2, "cough")])
    run()
    assert seen == [[1, 2], [3]]
    assert {r["hadm_id"] for r in incremental.read_entities(spark, store).collect()} == {1, 2, 3}
