"""Feature table per admission, standardisation and labels.

Every fact table is aggregated to one row per admission first, so both sides of each
left join are unique on ``hadm_id`` and share its hash partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casegraph.functions.scalars import clipped_or_zero
from casegraph.operators.aggregates import count_per_key, distinct_per_key, items_and_mean
from casegraph.operators.cohort import first_per_key
from casegraph.operators.ranking import category_codes

# Features of an admission in vector order.
FEATURES = [
    "anchor_age", "los_hours",
    "admission_type_enc", "insurance_enc", "marital_status_enc",
    "n_diagnoses", "n_medications", "n_procedures",
    "n_lab_tests", "mean_lab_value",
    "n_nlp_symptoms", "n_nlp_diseases", "n_nlp_medications",
]
CATEGORIES = ["admission_type", "insurance", "marital_status"]


def admission_features(
    admissions: DataFrame, patients: DataFrame, diagnoses: DataFrame, prescriptions: DataFrame,
    procedures: DataFrame, labs: DataFrame, entity_counts: DataFrame,
) -> DataFrame:
    """``hadm_id`` and the 13 features as doubles; whatever is missing counts as 0."""
    ages = first_per_key(patients.select("subject_id", "anchor_age"), ["subject_id"])
    base = admissions.select("hadm_id", "subject_id", "los_hours", *CATEGORIES)
    base = category_codes(base, CATEGORIES).join(ages, "subject_id", "left")
    base = base.withColumn("los_hours", clipped_or_zero(F.col("los_hours")))
    parts = [
        count_per_key(diagnoses, ["hadm_id"], "n_diagnoses"),
        distinct_per_key(prescriptions, ["hadm_id"], "drug", "n_medications"),
        count_per_key(procedures, ["hadm_id"], "n_procedures"),
        items_and_mean(labs, "hadm_id", "itemid", "valuenum", "n_lab_tests", "mean_lab_value"),
        entity_counts,
    ]
    for part in parts:
        base = base.join(part, "hadm_id", "left")
    return base.select("hadm_id", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in FEATURES])


def labels(admissions: DataFrame, flag: str = "hospital_expire_flag") -> DataFrame:
    return admissions.select("hadm_id", F.coalesce(F.col(flag).cast("int"), F.lit(0)).alias("label"))


def feature_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One (feature, mean, std) row per column from one pass; population deviation."""
    aggregated = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]
    )
    rows = [F.struct(F.lit(c).alias("feature"), F.col(f"m_{c}").alias("mean"), F.col(f"s_{c}").alias("std")) for c in columns]
    return aggregated.select(F.inline(F.array(*rows)))


@dataclass(frozen=True)
class Scaler:
    """Means and population deviations; a constant column is only centred."""

    columns: tuple[str, ...]
    means: tuple[float, ...]
    stds: tuple[float, ...]

    def scaled(self) -> list[Column]:
        return [
            (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - F.lit(m)) / F.lit(s if s > 0 else 1.0)
            for c, m, s in zip(self.columns, self.means, self.stds)
        ]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(dict(zip(self.columns, self.scaled())))

    def vectors(self, df: DataFrame, id_col: str = "hadm_id", name: str = "features") -> DataFrame:
        return df.select(id_col, F.array(*self.scaled()).alias(name))


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> Scaler:
    """Statistics of ``df``: pass the training rows, or all rows for parity with a fit on everything.

    Two numbers per column come to the driver, as with any fitted model.
    """
    rows = {row["feature"]: row for row in feature_stats(df, columns).collect()}
    return Scaler(
        tuple(columns),
        tuple(float(rows[c]["mean"] or 0.0) for c in columns),
        tuple(float(rows[c]["std"] or 0.0) for c in columns),
    )


def patient_features(patients: DataFrame, scaler: Scaler | None = None) -> DataFrame:
    """Standardised age per patient."""
    ages = patients.select("subject_id", F.coalesce(F.col("anchor_age").cast("double"), F.lit(0.0)).alias("anchor_age"))
    return (scaler or fit_scaler(ages, ["anchor_age"])).transform(ages)


def nonzero_fraction(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: share of non-zero cells of the feature matrix."""
    nonzero = sum((F.when(F.col(c) != 0, 1).otherwise(0) for c in columns), F.lit(0))
    return df.agg((F.sum(nonzero) / (F.count(F.lit(1)) * len(columns))).alias("density"))
