"""From raw tables to explained cases. Stages take and return DataFrames. Most of a stage runs
when its result is written; what several of its steps need is written to the shared folder
first, and fitting (scaler, split, model) runs at once."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casegraph.functions.scalars import hours_between
from casegraph.operators import cohort as co
from casegraph.operators import context as cx
from casegraph.operators import entities as en
from casegraph.operators import features as fe
from casegraph.operators import graph as gr
from casegraph.operators import knn
from casegraph.operators import metrics as me
from casegraph.operators import model as mo
from casegraph.operators import propagate as pr
from casegraph.operators import ranking as rk
from casegraph.operators.id_registry import extend_index
from casegraph.operators.report import funnel
from casegraph.session import at_once, materialize, shuffles_dropped
from casegraph.sources import sinks
from casegraph.sources.merged import MergedTable, merge_rows, read_merged
from casegraph.sources.readers import scan_parquet, scan_table
from casegraph.sources.schemas import DataLayout

# Plausible range of a lab value, youngest patient age, split seed.
LAB_RANGE = (-1000.0, 1_000_000.0)
MIN_AGE = 18
SEED = 42


@dataclass(frozen=True)
class CaseTables:
    admissions: DataFrame
    patients: DataFrame
    diagnoses: DataFrame
    procedures: DataFrame
    labs: DataFrame
    prescriptions: DataFrame
    notes: DataFrame


def written(tables: CaseTables) -> CaseTables:
    """Tables as a stage boundary: each is written once and read by the stages after it."""
    names = [f.name for f in fields(tables)]
    stored = at_once([lambda name=name: materialize(getattr(tables, name), name) for name in names])
    return CaseTables(**dict(zip(names, stored)))


def save_tables(tables: CaseTables, layout: DataLayout, stage: str) -> None:
    """Write the tables of a stage to the output folder; ``saved_tables`` reads them back."""
    at_once([lambda f=f: sinks.write_table(getattr(tables, f.name), layout.output(f"{stage}/{f.name}")) for f in fields(tables)])


def saved_tables(spark: SparkSession, layout: DataLayout, stage: str) -> CaseTables:
    return CaseTables(**{f.name: scan_parquet(spark, layout.output(f"{stage}/{f.name}")) for f in fields(CaseTables)})


def save_results(
    layout: DataLayout, reports: dict[str, DataFrame] | None = None, entities: DataFrame | None = None,
    embeddings: DataFrame | None = None, predictions: DataFrame | None = None, cases: DataFrame | None = None,
) -> None:
    """Write what the later stages made: reports, entity lists, embedding table, predictions and case results."""
    for name, report in (reports or {}).items():
        sinks.write_report(report, layout.output(f"reports/{name}"))
    if entities is not None:
        sinks.write_entities(entities, layout.output("entities"))
    for name, table in (("embeddings", embeddings), ("predictions", predictions)):
        if table is not None:
            sinks.write_table(table, layout.output(name))
    if cases is not None:
        sinks.write_case_results(cases, layout.output("cases"))


def load_tables(spark: SparkSession, layout: DataLayout, **options) -> CaseTables:
    def read(table: str) -> DataFrame:
        return scan_table(spark, layout, table, **options)

    return CaseTables(
        admissions=read("admissions"), patients=read("patients"), diagnoses=read("diagnoses"),
        procedures=read("procedures"), labs=read("labevents"), prescriptions=read("prescriptions"), notes=read("notes"),
    )


def extract_cohort(raw: CaseTables) -> tuple[CaseTables, DataFrame]:
    """Restrict every table to admissions that have a note. Returns the tables and a funnel report."""
    # Written once: six scans of the notes would follow otherwise, and a notes file may not be splittable.
    ids = materialize(co.cohort_ids(raw.notes.select("hadm_id"), "hadm_id"), "cohort")
    admissions = co.restrict(raw.admissions, ids, "hadm_id")
    kept = replace(
        raw,
        admissions=admissions,
        patients=co.restrict_parents(raw.patients, admissions, "subject_id"),
        diagnoses=co.restrict(raw.diagnoses, ids, "hadm_id"),
        procedures=co.restrict(raw.procedures, ids, "hadm_id"),
        labs=co.restrict(raw.labs, ids, "hadm_id"),
    )
    names = ("admissions", "patients", "diagnoses", "procedures", "labs")
    return kept, funnel([(n, "cohort", getattr(raw, n), getattr(kept, n)) for n in names])


def clean_tables(
    tables: CaseTables, propagate_patient_filter: bool = False, min_age: float = MIN_AGE
) -> tuple[CaseTables, DataFrame]:
    """Deduplicate and validate all tables; child rows follow the final admissions.

    ``propagate_patient_filter`` also drops the admissions of patients below ``min_age``,
    which otherwise stay with a patient that has no properties.
    """
    steps = []

    def step(table: str, name: str, before: DataFrame, after: DataFrame) -> DataFrame:
        steps.append((table, name, before, after))
        return after

    unique = step("admissions", "deduplicate", tables.admissions, co.first_per_key(tables.admissions, ["hadm_id"]))
    timed = step("admissions", "interval", unique, co.valid_interval(unique, "admittime", "dischtime"))
    admissions = timed.withColumn("los_hours", hours_between(F.col("admittime"), F.col("dischtime")))
    known = step("patients", "known", tables.patients, co.restrict_parents(tables.patients, tables.admissions, "subject_id"))
    patients = step("patients", "age", known, co.at_least(known, "anchor_age", min_age))
    if propagate_patient_filter:
        admissions = co.restrict_parents(admissions, patients, "subject_id")
    # Written once: every child table is restricted to them.
    admissions = materialize(admissions, "admissions")

    ids = admissions.select("hadm_id")

    def codes(table: str, rows: DataFrame) -> DataFrame:
        present = step(table, "missing", rows, co.drop_missing(rows, ["icd_code"]))
        distinct = step(table, "deduplicate", present, co.distinct_rows(present))
        return step(table, "admission", distinct, co.restrict(distinct, ids, "hadm_id"))

    diagnoses, procedures = codes("diagnoses", tables.diagnoses), codes("procedures", tables.procedures)
    values = step("labs", "range", tables.labs, co.plausible(tables.labs, "valuenum", *LAB_RANGE))
    labs = step("labs", "deduplicate", values, co.first_per_key(values, ["hadm_id", "itemid", "charttime"]))
    labs = step("labs", "admission", labs, co.restrict(labs, ids, "hadm_id"))
    named = step("prescriptions", "missing", tables.prescriptions, co.drop_missing(tables.prescriptions, ["drug"]))
    # the key has the admission, so rows of other admissions can go first and need no shuffle
    drugs = step("prescriptions", "admission", named, co.restrict(named, ids, "hadm_id"))
    drugs = step("prescriptions", "deduplicate", drugs, co.first_per_key(drugs, ["hadm_id", "drug", "starttime"]))
    cleaned = replace(
        tables, admissions=admissions, patients=patients, diagnoses=diagnoses, procedures=procedures, labs=labs,
        prescriptions=drugs,
    )
    return cleaned, funnel(steps)


def extract_entities(
    tables: CaseTables, mentions_of: Callable[[DataFrame], DataFrame], done: DataFrame | None = None
) -> DataFrame:
    """Raw entity lists per admission with a processed note; ``done`` are admissions to skip."""
    notes = en.select_notes(tables.notes, tables.admissions)
    if done is not None:
        notes = en.pending_notes(notes, done)
    return en.complete_entity_sets(en.entity_sets(mentions_of(notes)), notes)


def build_case_graph(tables: CaseTables, entities: DataFrame, multiplicity: str = "merge") -> tuple[gr.CaseGraph, DataFrame]:
    """Node and edge tables, and the validation report."""
    graph = gr.build_graph(
        tables.admissions, tables.patients, tables.diagnoses, tables.procedures, tables.prescriptions, tables.labs,
        en.clean_entity_sets(entities), multiplicity, write=materialize,
    )
    return graph, gr.validate_graph(graph)


# Identity of nodes and edges, and the properties that a later batch sets anew.
def _merged_tables(folder: str, buckets: int) -> dict[tuple[str, str], MergedTable]:
    found = {("nodes", name): MergedTable(f"{folder}/nodes/{name}", (key,), buckets=buckets) for name, key in gr.NODE_KEYS.items()}
    for name, (source, target) in gr.EDGE_ENDS.items():
        keys = (gr.NODE_KEYS[source], gr.NODE_KEYS[target], *(("starttime",) if name == "PRESCRIBED" else ()))
        overwrite = ("mean_value", "std_value") if name == "HAS_LAB" else ()
        found["edges", name] = MergedTable(f"{folder}/edges/{name}", keys, overwrite, buckets)
    return found


def merge_graph(graph: gr.CaseGraph, folder: str, buckets: int = 64) -> None:
    """Merge a batch of cases into the stored graph: nodes and edges that are new are added, those that are known keep
    their properties, and lab edges take the values of the batch. Only buckets with a key of the batch are rewritten."""
    tables = {"nodes": graph.nodes, "edges": graph.edges}
    merged = _merged_tables(folder, buckets)
    jobs = [lambda kind=kind, name=name, t=t: merge_rows(tables[kind][name], t) for (kind, name), t in merged.items() if name in tables[kind]]
    # the disk holds the shuffles of a few tables, not of all
    with shuffles_dropped(next(iter(graph.nodes.values())).sparkSession):
        at_once(jobs, most=3)


def read_graph(spark: SparkSession, folder: str) -> gr.CaseGraph:
    """The stored graph, all batches together."""
    found = {place: read_merged(spark, t) for place, t in _merged_tables(folder, 64).items()}
    of = {kind: {name: rows for (k, name), rows in found.items() if k == kind and rows is not None} for kind in ("nodes", "edges")}
    return gr.CaseGraph(of["nodes"], of["edges"])


@dataclass(frozen=True)
class TrainingGraph:
    """Standardised features, labels, split and integer-indexed edges."""

    admissions: DataFrame  # hadm_id, idx, features, label, split
    patients: DataFrame  # subject_id, idx, anchor_age (standardised)
    vocabularies: dict[str, DataFrame]  # node type -> key, idx, features (constant)
    edges: dict[str, DataFrame]  # edge type -> src_idx, dst_idx


def build_training_graph(
    tables: CaseTables, entities: DataFrame, fit_on: str = "train", index_folder: str | None = None
) -> TrainingGraph:
    """``fit_on``: scale by the training rows only, or by ``all`` rows.

    ``index_folder`` keeps the positions of nodes over increments: those of earlier runs stay, and vocabularies hold
    their items too. Without it the nodes of this run are numbered anew.
    """
    facts = {
        "DIAGNOSED_WITH": (tables.diagnoses, "icd_code", "Diagnosis"),
        "PRESCRIBED": (tables.prescriptions, "drug", "Medication"),
        "HAS_PROCEDURE": (tables.procedures, "icd_code", "Procedure"),
        "HAS_LAB": (gr.lab_pairs(tables.labs), "itemid", "LabTest"),
    }
    kept = {
        name: gr.fact_edges(table, tables.admissions, item, multiplicity="row") for name, (table, item, _) in facts.items()
    }

    def examples() -> DataFrame:
        raw = fe.admission_features(
            tables.admissions, tables.patients, tables.diagnoses, tables.prescriptions, tables.procedures, tables.labs,
            en.entity_counts(entities),
        )
        raw = materialize(raw.join(fe.labels(tables.admissions), "hadm_id"), "features")
        parted = rk.split_exact(raw, "hadm_id", SEED)
        scaler = fe.fit_scaler(parted.where("split = 'train'") if fit_on == "train" else parted, fe.FEATURES)
        return parted.select("hadm_id", "label", "split", F.array(*scaler.scaled()).alias("features"))

    def positions(table: DataFrame, key: str, node_type: str) -> DataFrame:
        known = extend_index(table, key, f"{index_folder}/{node_type}") if index_folder else None
        return rk.dense_index(table, key) if known is None else known.select(key, "idx")

    jobs = [
        examples,
        lambda: fe.patient_features(tables.patients),
        lambda: positions(tables.admissions, "hadm_id", "Admission"),
        lambda: positions(tables.patients, "subject_id", "Patient"),
        *[lambda name=name, item=item, node=node: positions(kept[name], item, node) for name, (_, item, node) in facts.items()],
    ]
    rows, ages, index, patient_index, *indexes = at_once(jobs)
    vocabularies, edges = {}, {}
    edges["HAS_ADMISSION"] = gr.indexed_edges(tables.admissions, "subject_id", patient_index, "hadm_id", index)
    for (edge_type, (_, item, node_type)), vocabulary in zip(facts.items(), indexes):
        # these nodes have no properties: their feature is a constant
        vocabularies[node_type] = vocabulary.withColumn("features", F.array(F.lit(1.0)))
        edges[edge_type] = gr.indexed_edges(kept[edge_type], "hadm_id", index, item, vocabulary)
    return TrainingGraph(rows.join(index, "hadm_id"), ages.join(patient_index, "subject_id"), vocabularies, edges)


@dataclass(frozen=True)
class Evaluation:
    model: mo.TrainedModel
    predictions: DataFrame  # hadm_id, label, split, prob, pred
    report: DataFrame
    embeddings: DataFrame  # hadm_id, idx, embedding: what the classifier saw, for retrieval


def train_and_evaluate(graph: TrainingGraph, with_neighbourhood: bool = True) -> Evaluation:
    """Weighted classifier on own and neighbourhood features, chosen by validation AUC, tested once."""
    rows = graph.admissions
    if with_neighbourhood:
        # Written once: the hop to the items and the hop back both read them.
        pairs = {
            name: materialize(
                table.select(F.col("src_idx").alias("case"), F.col("dst_idx").alias("item")).distinct(), f"pairs-{name.lower()}"
            )
            for name, table in graph.edges.items()
            if name != "HAS_ADMISSION"
        }
        wide = pr.neighbourhood_features(rows, pairs, len(fe.FEATURES), "idx")
        rows = rows.drop("features").join(wide, "idx")
    rows = materialize(rows, "examples")
    balanced = rk.undersample(rows.where("split = 'train'"), "hadm_id", "label", seed=SEED)
    trained = mo.train(balanced, rows.where("split = 'val'"))
    predictions = mo.score(trained.model, rows).select("hadm_id", "label", "split", "prob", "pred")
    embeddings = rows.select("hadm_id", "idx", F.col("features").alias("embedding"))
    return Evaluation(trained, predictions, me.metric_report(predictions.where("split = 'test'")), embeddings)


def explain_cases(
    graph: gr.CaseGraph, embeddings: DataFrame, predictions: DataFrame, queries: DataFrame | None = None, k: int = 5
) -> DataFrame:
    """Prompt and neighbours for each query case (``hadm_id``, or ``idx`` of the embeddings); the first test case if none is given.

    ``embeddings`` are (hadm_id, embedding); ``predictions`` need ``prob``, and ``split`` for the default case.
    An id that is not among the embeddings is an error.
    """
    if queries is None:
        queries = rk.first_in_split(predictions, "hadm_id")
    if "hadm_id" not in queries.columns:
        missing = queries.join(embeddings, "idx", "left_anti").limit(1).collect()
        if missing:
            raise ValueError(f"there is no case at position {missing[0]['idx']}")
        queries = embeddings.join(queries, "idx", "left_semi").select("hadm_id")
    unknown = knn.lookup(queries, embeddings).where(~F.col("found")).limit(1).collect()
    if unknown:
        raise ValueError(f"hadm_id {unknown[0]['hadm_id']} has no embedding")
    asked = embeddings.join(queries.select("hadm_id").distinct(), "hadm_id", "left_semi")
    neighbours = materialize(knn.nearest(asked, embeddings, k, "hadm_id"), "neighbours")
    wanted = queries.select("hadm_id").union(neighbours.select("neighbor_id")).distinct()
    contexts = cx.case_context(queries, neighbours, cx.case_profiles(graph, wanted))
    return cx.case_prompts(contexts, predictions)
