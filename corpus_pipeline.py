"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from casegraph.llm import decontaminate, line_dedup, packing, quality_rules, simhash  # noqa: E402
from casegraph.llm.columns import with_length  # noqa: E402
from casegraph.session import drop_table, materialize  # noqa: E402


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a rule, or whose host does too often, go."""
    return quality_rules.keep_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand in an earlier document, or earlier in the same, go."""
    return with_length(line_dedup.without_repeated_lines(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays whose fingerprints link: three-word shingles, three bits."""
    return simhash.keep_first(docs, budget=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark go."""
    return with_length(decontaminate.remove_spans(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents packed into sequences of 1,024 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", rules),
    ("line dedup", lines),
    ("near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("packing", sequences),
]

#: SQL has no XXH64, so no SQL gives the rows; the pipeline is tested stage by stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, name.lower().replace(" ", "-"))
            drop_table(before)  # the next stage reads what this one wrote
    return docs
