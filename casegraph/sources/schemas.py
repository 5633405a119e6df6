"""Explicit schemas of the clinical input tables and the layout of a data folder."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


_LONG, _INT, _DOUBLE, _TEXT, _TIME = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.TimestampType()

# Codes are strings so that leading zeros survive.
SCHEMAS = {
    "notes": _struct(hadm_id=_LONG, text=_TEXT),
    "admissions": _struct(
        subject_id=_LONG, hadm_id=_LONG, admittime=_TIME, dischtime=_TIME, admission_type=_TEXT,
        insurance=_TEXT, marital_status=_TEXT, race=_TEXT, hospital_expire_flag=_INT,
    ),
    "patients": _struct(subject_id=_LONG, gender=_TEXT, anchor_age=_INT),
    "diagnoses": _struct(subject_id=_LONG, hadm_id=_LONG, seq_num=_INT, icd_code=_TEXT, icd_version=_INT),
    "procedures": _struct(subject_id=_LONG, hadm_id=_LONG, seq_num=_INT, icd_code=_TEXT, icd_version=_INT),
    "labevents": _struct(hadm_id=_LONG, itemid=_INT, charttime=_TIME, valuenum=_DOUBLE),
    "prescriptions": _struct(hadm_id=_LONG, drug=_TEXT, starttime=_TIME),
}

ENTITY_SCHEMA = T.StructType(
    [T.StructField("hadm_id", T.LongType())]
    + [T.StructField(k, T.ArrayType(T.StringType())) for k in ("symptoms", "diseases", "medications")]
)


@dataclass(frozen=True)
class DataLayout:
    """Where the tables are and where results go; passed explicitly, never read from global state."""

    tables_dir: str
    notes_dir: str
    output_dir: str
    files: dict[str, str] = field(
        default_factory=lambda: {
            "notes": "discharge.csv",
            "admissions": "admissions.csv",
            "patients": "patients.csv",
            "diagnoses": "diagnoses_icd.csv",
            "procedures": "procedures_icd.csv",
            "labevents": "labevents.csv",
            "prescriptions": "prescriptions.csv",
        }
    )

    def path(self, table: str) -> str:
        folder = self.notes_dir if table == "notes" else self.tables_dir
        return f"{folder.rstrip('/')}/{self.files[table]}"

    def output(self, name: str) -> str:
        return f"{self.output_dir.rstrip('/')}/{name}"
