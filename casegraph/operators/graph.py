"""Case graph: one table per node type, one table per edge type.

``multiplicity`` of edges is ``merge`` (one edge per identity, as in a property graph) or
``row`` (one edge per source row, as in a tensor view). Fact rows are the left side of
every join and are reduced to distinct identities before it where the result allows.
A whole graph deals each fact table by admission once; the operators then need no further
shuffle of its rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casegraph.operators.aggregates import profile_per_key
from casegraph.operators.cohort import first_per_key

# Property lists of the two node types that carry properties.
PATIENT_PROPERTIES = ["gender", "anchor_age"]
ADMISSION_PROPERTIES = [
    "admittime", "dischtime", "admission_type", "insurance", "marital_status", "race", "los_hours",
    "hospital_expire_flag",
]

# Edge type -> (source node type, target node type).
EDGE_ENDS = {
    "HAS_ADMISSION": ("Patient", "Admission"),
    "DIAGNOSED_WITH": ("Admission", "Diagnosis"),
    "PRESCRIBED": ("Admission", "Medication"),
    "HAS_PROCEDURE": ("Admission", "Procedure"),
    "HAS_LAB": ("Admission", "LabTest"),
}

# Key column of each node type.
NODE_KEYS = {
    "Patient": "subject_id",
    "Admission": "hadm_id",
    "Diagnosis": "icd_code",
    "Medication": "drug",
    "Procedure": "icd_code",
    "LabTest": "itemid",
}


def patient_nodes(admissions: DataFrame, patients: DataFrame) -> DataFrame:
    """Patients of the given admissions; one without a patient row keeps null properties."""
    ids = admissions.where(F.col("subject_id").isNotNull()).select("subject_id").distinct()
    known = first_per_key(patients.select("subject_id", *PATIENT_PROPERTIES), ["subject_id"])
    return ids.join(known, "subject_id", "left")


def admission_nodes(admissions: DataFrame) -> DataFrame:
    """One whole row per admission, the first in the order of its properties.

    Taken as a minimum, so that properties nobody reads (when nodes are counted) are not shuffled.
    """
    first = admissions.groupBy("hadm_id").agg(F.min(F.struct(*ADMISSION_PROPERTIES)).alias("_first"))
    return first.select("hadm_id", *[F.col("_first")[c].alias(c) for c in ADMISSION_PROPERTIES])


def has_admission_edges(admissions: DataFrame) -> DataFrame:
    pairs = admissions.select("subject_id", "hadm_id")
    return pairs.where(F.col("subject_id").isNotNull() & F.col("hadm_id").isNotNull()).distinct()


def _present(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``rows.na.drop(subset=columns)`` in plain null tests, which code nodes have too, so that Spark sees that the shuffles are the same."""
    for c in columns:
        rows = rows.where(F.col(c).isNotNull())
    numbers = [c for c, kind in rows.dtypes if c in columns and kind in ("float", "double")]
    return rows.na.drop(subset=numbers) if numbers else rows


def fact_edges(
    facts: DataFrame, admissions: DataFrame, item: str, properties: tuple[str, ...] = (), multiplicity: str = "merge"
) -> DataFrame:
    """Edges from admissions to the items of a fact table (diagnoses, procedures, prescriptions).

    With ``merge`` the properties are part of the identity and must be present; rows of
    unknown admissions are dropped in both modes.
    """
    if multiplicity not in ("merge", "row"):
        raise ValueError("multiplicity must be 'merge' or 'row'")
    columns = ["hadm_id", item, *properties]
    rows = facts.select(*columns).where(F.col(item).isNotNull())
    if multiplicity == "merge":
        rows = _present(rows, columns).distinct()
    known = admissions.select("hadm_id").distinct()
    return rows.join(known, "hadm_id", "left_semi")


def lab_edges(labs: DataFrame, admissions: DataFrame) -> DataFrame:
    """One edge per admission and lab test with mean and sample deviation of its values."""
    profile = profile_per_key(labs.where(F.col("itemid").isNotNull()), ["hadm_id", "itemid"], "valuenum")
    return profile.join(admissions.select("hadm_id").distinct(), "hadm_id", "left_semi")


def lab_pairs(labs: DataFrame) -> DataFrame:
    return labs.select("hadm_id", "itemid").distinct()


def item_nodes(edges: DataFrame, item: str) -> DataFrame:
    """Vocabulary nodes: items that occur on an edge."""
    return edges.select(item).distinct()


def code_nodes(facts: DataFrame, admissions: DataFrame | None, versioned: bool = False) -> DataFrame:
    """Diagnosis or procedure nodes of the known admissions (of all rows if ``admissions`` is None).

    The node key is the code; a code that occurs in two code systems gets its lowest
    version. ``versioned`` makes the version part of the key instead.
    """
    codes = facts.where(F.col("icd_code").isNotNull())
    if admissions is not None:
        codes = codes.select("hadm_id", "icd_code", "icd_version").distinct()
        codes = codes.join(admissions.select("hadm_id").distinct(), "hadm_id", "left_semi")
    if versioned:
        return codes.select("icd_code", "icd_version").distinct()
    return codes.groupBy("icd_code").agg(F.min("icd_version").alias("icd_version"))


def enrich_admissions(nodes: DataFrame, entity_lists: DataFrame) -> DataFrame:
    """Admission nodes with the cleaned mention lists of their notes (null without a processed note)."""
    lists = entity_lists.select(
        "hadm_id", *[F.col(c).alias(f"extracted_{c}") for c in ("symptoms", "diseases", "medications")]
    )
    return nodes.join(lists, "hadm_id", "left")


def by_admission(facts: DataFrame) -> DataFrame:
    """Fact rows dealt by their admission; rows without one belong to no graph and are left out.

    Identities, profiles and the join with the admissions all contain ``hadm_id``, so this one shuffle serves them. In
    return, the rows of one admission are reduced, and joined, by one task.
    """
    return facts.where(F.col("hadm_id").isNotNull()).repartition("hadm_id")


@dataclass
class CaseGraph:
    nodes: dict[str, DataFrame] = field(default_factory=dict)
    edges: dict[str, DataFrame] = field(default_factory=dict)


def build_graph(
    admissions: DataFrame, patients: DataFrame, diagnoses: DataFrame, procedures: DataFrame,
    prescriptions: DataFrame, labs: DataFrame, entity_lists: DataFrame | None = None, multiplicity: str = "merge",
    write: Callable[[DataFrame, str], DataFrame] = lambda table, name: table, deal: bool = True,
) -> CaseGraph:
    """Node and edge tables. ``write`` may store the edge tables of which nodes are derived, so that they are made once.

    ``deal`` shuffles every fact table once, by admission. Without it, edges are shuffled by their whole identity first, which a merge
    into a stored graph asks for as well.
    """
    if deal:
        labs = by_admission(labs)
    if deal and multiplicity == "merge":
        diagnoses, procedures, prescriptions = (by_admission(t) for t in (diagnoses, procedures, prescriptions))
    nodes, edges = {}, {}
    nodes["Patient"] = patient_nodes(admissions, patients)
    nodes["Admission"] = admission_nodes(admissions)
    if entity_lists is not None:
        nodes["Admission"] = enrich_admissions(nodes["Admission"], entity_lists)
    edges["HAS_ADMISSION"] = has_admission_edges(admissions)
    edges["DIAGNOSED_WITH"] = fact_edges(diagnoses, admissions, "icd_code", multiplicity=multiplicity)
    edges["PRESCRIBED"] = write(fact_edges(prescriptions, admissions, "drug", ("starttime",), multiplicity), "prescribed")
    edges["HAS_PROCEDURE"] = fact_edges(procedures, admissions, "icd_code", multiplicity=multiplicity)
    edges["HAS_LAB"] = write(lab_edges(labs, admissions), "has-lab")
    nodes["Diagnosis"] = code_nodes(diagnoses, admissions)
    nodes["Medication"] = item_nodes(edges["PRESCRIBED"], "drug")
    nodes["Procedure"] = code_nodes(procedures, admissions)
    nodes["LabTest"] = item_nodes(edges["HAS_LAB"], "itemid")
    return CaseGraph(nodes, edges)


def long_edges(edges: dict[str, DataFrame]) -> DataFrame:
    """All edges as (edge_type, src, dst) with keys as text."""
    parts = []
    for edge_type, table in edges.items():
        source, target = EDGE_ENDS[edge_type]
        parts.append(
            table.select(
                F.lit(edge_type).alias("edge_type"),
                F.col(NODE_KEYS[source]).cast("string").alias("src"),
                F.col(NODE_KEYS[target]).cast("string").alias("dst"),
            )
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def undirected(edges: DataFrame) -> DataFrame:
    """Adds every edge in reverse, its type prefixed by ``rev_``."""
    reverse_type = F.concat(F.lit("rev_"), "edge_type")
    forward = F.struct(F.col("edge_type").alias("edge_type"), F.col("src").alias("src"), F.col("dst").alias("dst"))
    reverse = F.struct(reverse_type.alias("edge_type"), F.col("dst").alias("src"), F.col("src").alias("dst"))
    return edges.select(F.inline(F.array(forward, reverse)))


def indexed_edges(edges: DataFrame, src: str, src_index: DataFrame, dst: str, dst_index: DataFrame) -> DataFrame:
    """Edges as (src_idx, dst_idx); edges without an indexed end are dropped. Parallel edges stay."""
    left = src_index.select(F.col(src), F.col("idx").alias("src_idx"))
    right = dst_index.select(F.col(dst), F.col("idx").alias("dst_idx"))
    return edges.select(src, dst).join(left, src).join(right, dst).select("src_idx", "dst_idx")


def node_degree(edges: DataFrame) -> DataFrame:
    return edges.groupBy("edge_type", "src").agg(F.count(F.lit(1)).alias("degree"))


def graph_stats(graph: CaseGraph) -> DataFrame:
    """Number of nodes and edges per type, as (kind, type, n)."""
    parts = [
        table.agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), F.lit(name).alias("type"), "n")
        for kind, tables in (("node", graph.nodes), ("edge", graph.edges))
        for name, table in tables.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def duplicate_keys(nodes: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return nodes.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def unlinked(nodes: DataFrame, edges: DataFrame, key: str) -> DataFrame:
    """Nodes without an edge."""
    return nodes.join(edges.select(key).distinct(), key, "left_anti")


def _check(name: str, rows: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    status: Column = F.when(n == 0, F.lit("OK")).otherwise(F.concat(F.lit("WARNING: "), n.cast("string"), F.lit(" found")))
    return rows.agg(n.alias("count"), status.alias("status")).select(F.lit(name).alias("check"), "count", "status")


# Names of the validation checks.
ORPHAN_ADMISSIONS = "Orphan Admissions (no Patient)"
ORPHAN_DIAGNOSES = "Orphan Diagnoses (no Admission)"
ORPHAN_PROCEDURES = "Orphan Procedures (no Admission)"
NEGATIVE_STAYS = "Admissions with negative LOS"


def orphan_admissions(graph: CaseGraph) -> DataFrame:
    return _check(ORPHAN_ADMISSIONS, unlinked(graph.nodes["Admission"], graph.edges["HAS_ADMISSION"], "hadm_id"))


def orphan_diagnoses(graph: CaseGraph) -> DataFrame:
    return _check(ORPHAN_DIAGNOSES, unlinked(graph.nodes["Diagnosis"], graph.edges["DIAGNOSED_WITH"], "icd_code"))


def orphan_procedures(graph: CaseGraph) -> DataFrame:
    return _check(ORPHAN_PROCEDURES, unlinked(graph.nodes["Procedure"], graph.edges["HAS_PROCEDURE"], "icd_code"))


def negative_stays(graph: CaseGraph) -> DataFrame:
    return _check(NEGATIVE_STAYS, graph.nodes["Admission"].where("los_hours < 0"))


def unique_node_keys(graph: CaseGraph) -> DataFrame:
    """Number of repeated keys per node type."""
    parts = [
        _check(f"Duplicate {name} keys", duplicate_keys(table.select(NODE_KEYS[name]), [NODE_KEYS[name]]))
        for name, table in graph.nodes.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def validate_graph(graph: CaseGraph, unique_keys: bool = True) -> DataFrame:
    """All checks as (check, count, status)."""
    report = orphan_admissions(graph)
    for check in (orphan_diagnoses, orphan_procedures, negative_stays):
        report = report.unionByName(check(graph))
    return report.unionByName(unique_node_keys(graph)) if unique_keys else report
