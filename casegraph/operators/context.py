"""Case profiles and the text documents rendered from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casegraph.functions.scalars import fixed1, outcome_label, risk_label
from casegraph.functions.text import list_or_none
from casegraph.operators.graph import CaseGraph

# Layout of the context document, in the order of its lines.
QUERY_HEAD = "=== PATIENT QUERY ==="
QUERY_LINES = [
    "Admission type : ",
    "Length of stay : ",
    "Diagnoses      : ",
    "Medications    : ",
    "Procedures     : ",
    "NLP Symptoms   : ",
    "NLP Diseases   : ",
]
SIMILAR_HEAD = "=== SIMILAR PAST PATIENTS (retrieved by GNN embeddings) ==="
SIMILAR_TITLE = ("[Similar Patient ", "] — Outcome: ")
SIMILAR_LINES = [
    "  Diagnoses  : ",
    "  Medications: ",
    "  Procedures : ",
    "  LOS (hrs)  : ",
]

# The two messages for a language model; {prediction} and {context} are filled in.
SYSTEM_PROMPT = (
    "You are a clinical decision support assistant. "
    "You are given structured information about a hospitalized patient "
    "and a list of clinically similar past patients with known outcomes. "
    "Your task is to explain, in clear medical language, why the predictive model "
    "predicted the given outcome for this patient, referencing the clinical evidence provided. "
    "Be concise, factual, and do not invent information not present in the context."
)
USER_PROMPT = """
The GNN model predicted: **{prediction}**

Here is the clinical context retrieved from the Medical Knowledge Graph:

{context}

Based on this evidence, explain in 3-5 sentences why this prediction is clinically plausible,
referencing specific diagnoses, medications, procedures, or patterns from similar patients.
"""

_LISTS = {
    "diagnoses": ("DIAGNOSED_WITH", "icd_code"),
    "medications": ("PRESCRIBED", "drug"),
    "procedures": ("HAS_PROCEDURE", "icd_code"),
}


def case_labs(edges: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Per case its distinct (item, mean) results, sorted by item."""
    if ids is not None:
        edges = edges.join(ids.select("hadm_id"), "hadm_id", "left_semi")
    result = F.struct(F.col("itemid").alias("item"), F.col("mean_value").alias("mean"))
    return edges.groupBy("hadm_id").agg(F.array_sort(F.collect_set(result)).alias("lab_results"))


def case_profiles(graph: CaseGraph, ids: DataFrame | None = None) -> DataFrame:
    """One row per admission (of ``ids`` if given): properties and the sets of its neighbours by edge type.

    Each edge type is reduced to one row per case before it is joined, so the edge types
    do not multiply each other; parallel edges are dropped before anything is keyed by case.
    """
    nodes = graph.nodes["Admission"]
    if ids is not None:
        ids = ids.select("hadm_id").distinct()
        nodes = nodes.join(ids, "hadm_id", "left_semi")
    lists = ("symptoms", "diseases", "medications")
    extracted = [
        F.col(f"extracted_{c}") if f"extracted_{c}" in nodes.columns else F.lit(None).cast("array<string>") for c in lists
    ]
    profile = nodes.select(
        "hadm_id", "admission_type", "insurance", "los_hours", F.col("hospital_expire_flag").alias("died"),
        *[column.alias(f"nlp_{name}") for column, name in zip(extracted, lists)],
    )
    for name, (edge_type, item) in _LISTS.items():
        edges = graph.edges[edge_type].select("hadm_id", F.col(item).cast("string").alias("item")).distinct()
        if ids is not None:
            edges = edges.join(ids, "hadm_id", "left_semi")
        found = edges.groupBy("hadm_id").agg(F.array_sort(F.collect_set("item")).alias(name))
        profile = profile.join(found, "hadm_id", "left")
    profile = profile.join(case_labs(graph.edges["HAS_LAB"], ids), "hadm_id", "left")
    sets = list(_LISTS) + ["lab_results"]
    types = {f.name: f.dataType for f in profile.schema.fields}
    return profile.withColumns({c: F.coalesce(F.col(c), F.array().cast(types[c])) for c in sets})


def similar_cases(neighbours: DataFrame, profiles: DataFrame) -> DataFrame:
    """Neighbour rows (query_id, neighbor_id, distance, rank) with the profile of the neighbour."""
    return neighbours.join(profiles.withColumnRenamed("hadm_id", "neighbor_id"), "neighbor_id", "left")


def _hours_or_na(hours: Column, unit: str = "") -> Column:
    return F.coalesce(F.concat(fixed1(hours), F.lit(unit)), F.lit("N/A"))


def _query_text() -> Column:
    values = [
        F.when(F.col("found").isNull(), "N/A").otherwise(F.coalesce("admission_type", F.lit("None"))),
        _hours_or_na(F.col("los_hours"), " hours"),
        *[list_or_none(F.col(c)) for c in ("diagnoses", "medications", "procedures", "nlp_symptoms", "nlp_diseases")],
    ]
    lines = [F.concat(F.lit(label), value) for label, value in zip(QUERY_LINES, values)]
    return F.concat_ws("\n", F.lit(QUERY_HEAD), *lines, F.lit(""), F.lit(SIMILAR_HEAD))


def _similar_text() -> Column:
    title = F.concat(
        F.lit("\n" + SIMILAR_TITLE[0]), F.col("rank").cast("string"), F.lit(SIMILAR_TITLE[1]), outcome_label(F.col("died"))
    )
    values = [list_or_none(F.col(c)) for c in ("diagnoses", "medications", "procedures")] + [_hours_or_na(F.col("los_hours"))]
    return F.concat_ws("\n", title, *[F.concat(F.lit(label), v) for label, v in zip(SIMILAR_LINES, values)])


def case_context(queries: DataFrame, neighbours: DataFrame, profiles: DataFrame) -> DataFrame:
    """Per query case (``hadm_id``) the context document and the ids of its neighbours, nearest first."""
    own = profiles.withColumn("found", F.lit(True))
    heads = queries.select("hadm_id").distinct().join(own, "hadm_id", "left").select("hadm_id", _query_text().alias("head"))
    blocks = similar_cases(neighbours, profiles).select("query_id", "rank", "neighbor_id", _similar_text().alias("block"))
    # At most k rows per query.
    gathered = blocks.groupBy(F.col("query_id").alias("hadm_id")).agg(
        F.array_sort(F.collect_list(F.struct("rank", "neighbor_id", "block"))).alias("found")
    )
    joined = heads.join(gathered, "hadm_id", "left")
    return joined.select(
        "hadm_id",
        F.concat_ws("\n", "head", F.array_join(F.col("found.block"), "\n")).alias("context"),
        F.coalesce(F.col("found.neighbor_id"), F.array().cast("array<bigint>")).alias("similar_patients"),
    )


def case_prompts(contexts: DataFrame, predictions: DataFrame) -> DataFrame:
    """System and user message per case; predictions are (hadm_id, prob)."""
    before, rest = USER_PROMPT.split("{prediction}")
    middle, after = rest.split("{context}")
    labelled = predictions.select("hadm_id", risk_label(F.col("prob")).alias("prediction"))
    return contexts.join(labelled, "hadm_id", "left").select(
        "hadm_id",
        "prediction",
        "similar_patients",
        F.lit(SYSTEM_PROMPT).alias("system_prompt"),
        F.concat(
            F.lit(before), F.coalesce("prediction", F.lit("N/A")), F.lit(middle), "context", F.lit(after)
        ).alias("user_prompt"),
    )


def case_results(prompts: DataFrame, answers: DataFrame | None = None) -> DataFrame:
    """Result record per case; ``answers`` are (hadm_id, justification) of whatever model read the prompts."""
    if answers is None:
        with_text = prompts.withColumn("justification", F.lit(None).cast("string"))
    else:
        with_text = prompts.join(answers.select("hadm_id", "justification"), "hadm_id", "left")
    return with_text.select("hadm_id", "prediction", "similar_patients", "justification")
