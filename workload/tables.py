"""The clinical tables, derived from the test tables.

An order stands for an admission, a customer for a patient, a part on an order line for a
diagnosis (brand and size) and a procedure (type), a supplier for a drug, a line for a lab
value, and a document for the note of the order with the same number. ``CTES`` says the same in SQL.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casegraph.functions.scalars import hours_between
from casegraph.operators.cohort import at_least, valid_interval
from casegraph.operators.entities import (
    clean_entity_sets, complete_entity_sets, dictionary_mentions, entity_counts, entity_sets,
)
from casegraph.plans.stages import MIN_AGE
from casegraph.sources.readers import scan_parquet

DICTIONARY = [
    ("the", "symptom"), ("and", "symptom"), ("well", "symptom"), ("of the", "symptom"),
    ("der", "disease"), ("that", "disease"), ("is", "disease"), ("the the", "disease"),
    ("for", "medication"), ("la", "medication"), ("low", "medication"), ("de la", "medication"),
    ("licensed under the", "symptom"), ("licensed under the apache license", "disease"),
    ("is licensed under the", "medication"),
]
URGENT = ("1-URGENT", "2-HIGH")


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def scan(self, name: str, *columns: str) -> DataFrame:
        return scan_parquet(self.spark, f"{self.sf_dir}/{name}.parquet", columns)

    @cached_property
    def admissions_raw(self) -> DataFrame:
        lines = self.scan("lineitem", "l_orderkey", "l_shipdate", "l_returnflag").groupBy("l_orderkey").agg(
            F.max("l_shipdate").alias("dischtime"), F.min("l_returnflag").alias("insurance")
        )
        orders = self.scan("orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
        priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
        died = ((status == "F") & priority.isin(*URGENT)).cast("int")
        return orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left").select(
            F.col("o_orderkey").alias("hadm_id"), F.col("o_custkey").alias("subject_id"),
            F.col("o_orderdate").alias("admittime"), "dischtime", priority.alias("admission_type"), "insurance",
            F.nullif(priority, F.lit("4-NOT SPECIFIED")).alias("marital_status"), status.alias("race"),
            died.alias("hospital_expire_flag"),
        )

    @cached_property
    def admissions(self) -> DataFrame:
        """With a valid interval and the length of stay."""
        timed = valid_interval(self.admissions_raw, "admittime", "dischtime")
        return timed.withColumn("los_hours", hours_between(F.col("admittime"), F.col("dischtime")))

    @cached_property
    def patients_raw(self) -> DataFrame:
        return self.scan("customer", "c_custkey", "c_mktsegment", "c_acctbal").toDF("subject_id", "gender", "anchor_age")

    @cached_property
    def patients(self) -> DataFrame:
        return at_least(self.patients_raw, "anchor_age", MIN_AGE)

    def _codes(self, code) -> DataFrame:
        lines = self.scan("lineitem", "l_orderkey", "l_partkey")
        parts = self.scan("part", "p_partkey", "p_brand", "p_type", "p_size")
        return lines.join(parts, lines.l_partkey == parts.p_partkey).select(
            F.col("l_orderkey").alias("hadm_id"), code.alias("icd_code"),
            (F.col("p_partkey") % 2 + 9).cast("int").alias("icd_version"),
        )

    @cached_property
    def diagnoses_raw(self) -> DataFrame:
        return self._codes(F.concat("p_brand", F.lit("/"), F.col("p_size").cast("string")))

    @cached_property
    def procedures_raw(self) -> DataFrame:
        return self._codes(F.col("p_type"))

    @cached_property
    def diagnoses(self) -> DataFrame:
        return self.diagnoses_raw.distinct()

    @cached_property
    def procedures(self) -> DataFrame:
        return self.procedures_raw.distinct()

    @cached_property
    def prescriptions(self) -> DataFrame:
        return self.scan("lineitem", "l_orderkey", "l_suppkey", "l_shipdate").select(
            F.col("l_orderkey").alias("hadm_id"),
            F.concat(F.lit("drug "), F.col("l_suppkey").cast("string")).alias("drug"),
            F.col("l_shipdate").alias("starttime"),
        )

    @cached_property
    def labs(self) -> DataFrame:
        return self.scan("lineitem", "l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice").toDF(
            "hadm_id", "itemid", "charttime", "valuenum"
        )

    @cached_property
    def notes(self) -> DataFrame:
        return self.scan("documents", "doc_id", "text").toDF("hadm_id", "text")

    @cached_property
    def dictionary(self) -> DataFrame:
        return self.spark.createDataFrame(DICTIONARY, "term string, kind string")

    @cached_property
    def mentions(self) -> DataFrame:
        return dictionary_mentions(self.notes, self.dictionary)

    @cached_property
    def entity_sets(self) -> DataFrame:
        """Lists of every note's case, empty ones too."""
        return complete_entity_sets(entity_sets(self.mentions), self.notes)

    @cached_property
    def entity_counts(self) -> DataFrame:
        return entity_counts(self.entity_sets)

    @cached_property
    def entities(self) -> DataFrame:
        """Cleaned entity lists."""
        return clean_entity_sets(self.entity_sets)

    @cached_property
    def embeddings(self) -> DataFrame:
        return self.scan("embeddings", "vec_id", "embedding").toDF("hadm_id", "embedding")

    @cached_property
    def scored(self) -> DataFrame:
        """Labelled documents with a score that has many ties."""
        return self.scan("labels", "doc_id", "toxic").select(
            "doc_id", F.col("toxic").alias("label"), ((F.col("doc_id") * 37 % 101) / 101.0).alias("prob")
        )


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{cell}'" for cell in row) + ")" for row in rows)


# Name -> (names it needs, SQL).
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "adm_raw": (
        (),
        f"""SELECT o_orderkey AS hadm_id, o_custkey AS subject_id, o_orderdate AS admittime, dischtime,
            o_orderpriority AS admission_type, insurance, nullif(o_orderpriority, '4-NOT SPECIFIED') AS marital_status,
            o_orderstatus AS race,
            CASE WHEN o_orderstatus = 'F' AND o_orderpriority IN {URGENT} THEN 1 ELSE 0 END AS hospital_expire_flag
            FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS dischtime, min(l_returnflag) AS insurance
                                   FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey""",
    ),
    "adm": (
        ("adm_raw",),
        """SELECT *, (epoch_us(dischtime) - epoch_us(admittime)) / 3.6e9 AS los_hours FROM adm_raw
           WHERE dischtime >= admittime""",
    ),
    "pat_raw": ((), "SELECT c_custkey AS subject_id, c_mktsegment AS gender, c_acctbal AS anchor_age FROM customer"),
    "pat": (("pat_raw",), f"SELECT * FROM pat_raw WHERE anchor_age >= {MIN_AGE}"),
    "codes": (
        (),
        """SELECT l_orderkey AS hadm_id, p_brand || '/' || p_size AS diag, p_type AS proc,
           CAST(p_partkey % 2 + 9 AS INTEGER) AS icd_version FROM lineitem JOIN part ON l_partkey = p_partkey""",
    ),
    "diag": (("codes",), "SELECT DISTINCT hadm_id, diag AS icd_code, icd_version FROM codes"),
    "proc": (("codes",), "SELECT DISTINCT hadm_id, proc AS icd_code, icd_version FROM codes"),
    "presc": ((), "SELECT l_orderkey AS hadm_id, 'drug ' || l_suppkey AS drug, l_shipdate AS starttime FROM lineitem"),
    "labs": (
        (),
        """SELECT l_orderkey AS hadm_id, l_linenumber AS itemid, l_shipdate AS charttime, l_extendedprice AS valuenum
           FROM lineitem""",
    ),
    "dict": ((), f"SELECT * FROM (VALUES {_values(DICTIONARY)}) AS d(term, kind)"),
    "tok": (
        (),
        r"""SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS ws
            FROM documents""",
    ),
    "gram": (
        ("tok",),
        """SELECT doc_id, unnest(ws) AS term FROM tok UNION ALL
           SELECT doc_id, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) FROM tok UNION ALL
           SELECT doc_id, unnest(flatten(list_transform(range(1, len(ws)), lambda i:
             [array_to_string(ws[i:i + n], ' ') FOR n IN [2, 3, 4] IF i + n <= len(ws)]))) FROM tok""",
    ),
    "mention": (
        ("gram", "dict"),
        """SELECT doc_id AS hadm_id, term, kind, count(*) AS n FROM gram JOIN dict USING (term)
           GROUP BY doc_id, term, kind""",
    ),
    "mention_sets": (
        ("mention",),
        """SELECT hadm_id,
           coalesce(list_sort(list(DISTINCT term) FILTER (kind = 'symptom')), []) AS symptoms,
           coalesce(list_sort(list(DISTINCT term) FILTER (kind = 'disease')), []) AS diseases,
           coalesce(list_sort(list(DISTINCT term) FILTER (kind = 'medication')), []) AS medications
           FROM mention GROUP BY hadm_id""",
    ),
    "sets": (
        ("mention_sets",),
        """SELECT doc_id AS hadm_id, coalesce(symptoms, []) AS symptoms, coalesce(diseases, []) AS diseases,
           coalesce(medications, []) AS medications FROM documents LEFT JOIN mention_sets ON doc_id = hadm_id""",
    ),
    "clean_sets": (
        ("sets",),
        "SELECT hadm_id, "
        + ", ".join(
            f"""list_filter({c}, lambda w: NOT contains(w, '##') AND length(w) >= 3 AND
                w NOT IN ('well', 'sore', 'con', 'app', 'bad', 'low', 'high')) AS {c}"""
            for c in ("symptoms", "diseases", "medications")
        )
        + " FROM sets",
    ),
    "feat": (
        ("adm", "pat", "diag", "proc", "presc", "labs", "clean_sets"),
        """SELECT a.hadm_id, coalesce(p.anchor_age, 0.0)::DOUBLE AS anchor_age, greatest(los_hours, 0)::DOUBLE AS los_hours,
           (dense_rank() OVER (ORDER BY coalesce(admission_type, 'UNKNOWN')) - 1)::DOUBLE AS admission_type_enc,
           (dense_rank() OVER (ORDER BY coalesce(insurance, 'UNKNOWN')) - 1)::DOUBLE AS insurance_enc,
           (dense_rank() OVER (ORDER BY coalesce(marital_status, 'UNKNOWN')) - 1)::DOUBLE AS marital_status_enc,
           coalesce(d.n, 0)::DOUBLE AS n_diagnoses, coalesce(m.n, 0)::DOUBLE AS n_medications,
           coalesce(r.n, 0)::DOUBLE AS n_procedures, coalesce(l.n, 0)::DOUBLE AS n_lab_tests,
           coalesce(l.mean, 0)::DOUBLE AS mean_lab_value,
           coalesce(len(symptoms), 0)::DOUBLE AS n_nlp_symptoms, coalesce(len(diseases), 0)::DOUBLE AS n_nlp_diseases,
           coalesce(len(medications), 0)::DOUBLE AS n_nlp_medications
           FROM adm a LEFT JOIN pat p ON a.subject_id = p.subject_id
           LEFT JOIN (SELECT hadm_id, count(*) AS n FROM diag GROUP BY 1) d ON a.hadm_id = d.hadm_id
           LEFT JOIN (SELECT hadm_id, count(DISTINCT drug) AS n FROM presc GROUP BY 1) m ON a.hadm_id = m.hadm_id
           LEFT JOIN (SELECT hadm_id, count(*) AS n FROM proc GROUP BY 1) r ON a.hadm_id = r.hadm_id
           LEFT JOIN (SELECT hadm_id, count(DISTINCT itemid) AS n, avg(valuenum) AS mean FROM labs GROUP BY 1) l
             ON a.hadm_id = l.hadm_id
           LEFT JOIN clean_sets s ON a.hadm_id = s.hadm_id""",
    ),
    "lab_edge": (
        ("adm", "labs"),
        """SELECT hadm_id, itemid, avg(valuenum) AS mean_value, stddev_samp(valuenum) AS std_value FROM labs
           WHERE hadm_id IN (SELECT hadm_id FROM adm) GROUP BY hadm_id, itemid""",
    ),
    "profile": (
        ("adm", "diag", "proc", "presc", "clean_sets", "lab_edge"),
        """SELECT a.hadm_id, admission_type, insurance, los_hours, hospital_expire_flag AS died,
           s.symptoms AS nlp_symptoms, s.diseases AS nlp_diseases, s.medications AS nlp_medications,
           coalesce(d.items, []) AS diagnoses, coalesce(m.items, []) AS medications, coalesce(r.items, []) AS procedures,
           l.items AS labs
           FROM adm a LEFT JOIN clean_sets s ON a.hadm_id = s.hadm_id
           LEFT JOIN (SELECT hadm_id, list_sort(list(DISTINCT icd_code)) AS items FROM diag GROUP BY 1) d ON a.hadm_id = d.hadm_id
           LEFT JOIN (SELECT hadm_id, list_sort(list(DISTINCT drug)) AS items FROM presc GROUP BY 1) m ON a.hadm_id = m.hadm_id
           LEFT JOIN (SELECT hadm_id, list_sort(list(DISTINCT icd_code)) AS items FROM proc GROUP BY 1) r ON a.hadm_id = r.hadm_id
           LEFT JOIN (SELECT hadm_id, string_agg(itemid || '=' || floor(mean_value * 100 + 0.5003)::BIGINT, '|'
                      ORDER BY itemid) AS items FROM lab_edge GROUP BY 1) l ON a.hadm_id = l.hadm_id""",
    ),
    "emb_split": (
        (),
        """SELECT vec_id, CASE WHEN rn <= floor(0.8 * n) THEN 'train' WHEN rn <= floor(0.9 * n) THEN 'val' ELSE 'test' END AS split
           FROM (SELECT vec_id, count(*) OVER () AS n,
                        row_number() OVER (ORDER BY md5(vec_id || '|42'), vec_id) AS rn FROM embeddings)""",
    ),
    "pair": (
        (),
        """SELECT a.vec_id AS query_id, b.vec_id AS neighbor_id,
           list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) ** 2 AS distance
           FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id""",
    ),
    "near": (
        ("pair",),
        """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS rank
           FROM pair) WHERE rank <= 5""",
    ),
}


def with_ctes(names: str, body: str, **extra: str) -> str:
    """``body`` after the WITH clause of the named tables, all they need, and ``extra`` ones."""
    order: list[str] = []

    def add(name: str) -> None:
        if name not in order:
            for needed in CTES[name][0]:
                add(needed)
            order.append(name)

    for name in names.split():
        add(name)
    clauses = [f"{name} AS ({CTES[name][1]})" for name in order] + [f"{name} AS ({sql})" for name, sql in extra.items()]
    return f"WITH {', '.join(clauses)} {body}"
