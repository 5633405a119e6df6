"""Scans, cohort selection, filters, deduplication, aggregates, ranking and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from casegraph.functions import scalars as sc
from casegraph.operators import aggregates as ag
from casegraph.operators import cohort as co
from casegraph.operators import features as fe
from casegraph.operators import graph as gr
from casegraph.operators import model as mo
from casegraph.operators import ranking as rk
from casegraph.plans import stages
from casegraph.session import materialize
from workload.registry import q, q_sql, query
from workload.tables import Tables, with_ctes

# ---- scans and cohort


@query("scan_pruned", "SELECT l_orderkey, l_shipdate FROM lineitem")
def _(t: Tables):
    return t.scan("lineitem", "l_orderkey", "l_shipdate")


@query("cohort_ids", "SELECT DISTINCT doc_id AS hadm_id FROM documents WHERE doc_id IS NOT NULL")
def _(t: Tables):
    return co.cohort_ids(t.notes, "hadm_id")


@query("cohort_semi", with_ctes("labs", "SELECT * FROM labs WHERE hadm_id IN (SELECT doc_id FROM documents)"))
def _(t: Tables):
    return co.restrict(t.labs, co.cohort_ids(t.notes, "hadm_id"), "hadm_id")


@query(
    "cohort_cascade",
    with_ctes(
        "pat_raw",
        """SELECT * FROM pat_raw WHERE subject_id IN
           (SELECT o_custkey FROM orders WHERE o_orderkey IN (SELECT doc_id FROM documents))""",
    ),
)
def _(t: Tables):
    kept = co.restrict(t.admissions_raw, co.cohort_ids(t.notes, "hadm_id"), "hadm_id")
    return co.restrict_parents(t.patients_raw, kept, "subject_id")


@query(
    "cohort_excluded",
    with_ctes(
        "adm_raw",
        """SELECT hadm_id, subject_id, 'no note' AS reason FROM adm_raw
           WHERE hadm_id NOT IN (SELECT doc_id FROM documents)""",
    ),
)
def _(t: Tables):
    rows = t.admissions_raw.select("hadm_id", "subject_id")
    return co.excluded(rows, co.cohort_ids(t.notes, "hadm_id"), "hadm_id", "no note")


@query(
    "drop_nulls",
    with_ctes("adm_raw", "SELECT hadm_id, dischtime, insurance FROM adm_raw WHERE dischtime IS NOT NULL AND insurance IS NOT NULL"),
)
def _(t: Tables):
    return co.drop_missing(t.admissions_raw, ["dischtime", "insurance"]).select("hadm_id", "dischtime", "insurance")


@query(
    "valid_interval",
    with_ctes("adm_raw", "SELECT hadm_id, admittime, dischtime FROM adm_raw WHERE dischtime >= admittime"),
)
def _(t: Tables):
    return co.valid_interval(t.admissions_raw, "admittime", "dischtime").select("hadm_id", "admittime", "dischtime")


@query("min_threshold", with_ctes("pat_raw", f"SELECT * FROM pat_raw WHERE anchor_age >= {stages.MIN_AGE}"))
def _(t: Tables):
    return co.at_least(t.patients_raw, "anchor_age", stages.MIN_AGE)


@query("range_filter", with_ctes("labs", "SELECT * FROM labs WHERE valuenum BETWEEN 1000 AND 50000"))
def _(t: Tables):
    return co.plausible(t.labs, "valuenum", 1000, 50000)


@query(
    "dedup_key",
    with_ctes(
        "labs",
        """SELECT hadm_id, itemid, charttime, valuenum FROM (SELECT *, row_number() OVER
           (PARTITION BY hadm_id, itemid ORDER BY charttime, valuenum) AS rn FROM labs) WHERE rn = 1""",
    ),
)
def _(t: Tables):
    return co.first_per_key(t.labs, ["hadm_id", "itemid"], ["charttime"])


@query("dedup_row", with_ctes("codes", "SELECT DISTINCT hadm_id, proc AS icd_code, icd_version FROM codes"))
def _(t: Tables):
    return co.distinct_rows(t.procedures_raw)


@query("edge_lab_pairs", with_ctes("labs", "SELECT DISTINCT hadm_id, itemid FROM labs"))
def _(t: Tables):
    return gr.lab_pairs(t.labs)


# Table, step, rows before, rows after.
_FUNNEL = [
    ("admissions", "cohort", "adm_raw", "c_adm"),
    ("patients", "cohort", "pat_raw", "c_pat"),
    ("diagnoses", "cohort", "codes", "c_codes"),
    ("procedures", "cohort", "codes", "c_codes"),
    ("labs", "cohort", "labs", "c_labs"),
    ("admissions", "deduplicate", "c_adm", "c_adm"),
    ("admissions", "interval", "c_adm", "v_adm"),
    ("patients", "age", "c_pat", "v_pat"),
    ("diagnoses", "deduplicate", "c_codes", "c_diag"),
    ("procedures", "deduplicate", "c_codes", "c_proc"),
    ("labs", "range", "c_labs", "v_labs"),
    ("prescriptions", "admission", "presc", "r_presc"),
    ("prescriptions", "deduplicate", "r_presc", "v_presc"),
]


@query(
    "funnel_report",
    with_ctes(
        "adm_raw pat_raw codes labs presc",
        "SELECT *, before - after AS dropped FROM ("
        + " UNION ALL ".join(
            f"""SELECT '{table}' AS "table", '{step}' AS step, (SELECT count(*) FROM {before}) AS before,
                (SELECT count(*) FROM {after}) AS after"""
            for table, step, before, after in _FUNNEL
        )
        + ")",
        c_adm="SELECT * FROM adm_raw WHERE hadm_id IN (SELECT doc_id FROM documents)",
        v_adm="SELECT * FROM c_adm WHERE dischtime >= admittime",
        c_pat="SELECT * FROM pat_raw WHERE subject_id IN (SELECT subject_id FROM c_adm)",
        v_pat="SELECT * FROM c_pat WHERE anchor_age >= 18",
        c_codes="SELECT * FROM codes WHERE hadm_id IN (SELECT doc_id FROM documents)",
        c_diag="SELECT DISTINCT hadm_id, diag, icd_version FROM c_codes",
        c_proc="SELECT DISTINCT hadm_id, proc, icd_version FROM c_codes",
        c_labs="SELECT * FROM labs WHERE hadm_id IN (SELECT doc_id FROM documents)",
        v_labs="SELECT * FROM c_labs WHERE valuenum BETWEEN -1000 AND 1000000",
        r_presc="SELECT * FROM presc WHERE hadm_id IN (SELECT hadm_id FROM v_adm)",
        v_presc="SELECT DISTINCT hadm_id, drug, starttime FROM r_presc",
    ),
)
def _(t: Tables):
    raw = stages.CaseTables(
        t.admissions_raw, t.patients_raw, t.diagnoses_raw, t.procedures_raw, t.labs, t.prescriptions, t.notes
    )
    cohort, selection = stages.extract_cohort(raw)
    _, cleaning = stages.clean_tables(cohort)
    shown = [f"{table} {step}" for table, step, _, _ in _FUNNEL]
    return selection.unionByName(cleaning).where(F.concat_ws(" ", "table", "step").isin(shown))


# ---- joins and aggregates


@query(
    "admission_patient",
    with_ctes(
        "adm_raw pat",
        """SELECT hadm_id, a.subject_id, admission_type, gender, anchor_age
           FROM adm_raw a LEFT JOIN pat p ON a.subject_id = p.subject_id""",
    ),
)
def _(t: Tables):
    admissions = t.admissions_raw.select("hadm_id", "subject_id", "admission_type")
    return admissions.join(t.patients, "subject_id", "left")


@query("count_per_case", with_ctes("codes", "SELECT hadm_id, count(*) AS n FROM codes GROUP BY hadm_id"))
def _(t: Tables):
    return ag.count_per_key(t.diagnoses_raw, ["hadm_id"])


@query("distinct_per_case", with_ctes("presc", "SELECT hadm_id, count(DISTINCT drug) AS n FROM presc GROUP BY hadm_id"))
def _(t: Tables):
    return ag.distinct_per_key(t.prescriptions, ["hadm_id"], "drug")


@query(
    "lab_mean", with_ctes("labs", f"SELECT hadm_id, {q_sql('avg(valuenum)')} AS mean FROM labs GROUP BY hadm_id")
)
def _(t: Tables):
    means = ag.mean_per_key(t.labs, ["hadm_id"], "valuenum")
    return means.select("hadm_id", q(F.col("mean")).alias("mean"))


@query(
    "lab_profile",
    f"""SELECT user_id, event_type, {q_sql('avg(value)')} AS mean_value, {q_sql('stddev_samp(value)')} AS std_value
        FROM events GROUP BY user_id, event_type""",
)
def _(t: Tables):
    profile = ag.profile_per_key(t.scan("events", "user_id", "event_type", "value"), ["user_id", "event_type"], "value")
    return profile.select(
        "user_id", "event_type", q(F.col("mean_value")).alias("mean_value"), q(F.col("std_value")).alias("std_value")
    )


@query("los_hours", with_ctes("adm", f"SELECT hadm_id, {q_sql('los_hours')} AS los_hours FROM adm"))
def _(t: Tables):
    return t.admissions.select("hadm_id", q(F.col("los_hours")).alias("los_hours"))


# ---- features and labels


_FEATURE_SQL = ", ".join(f"{q_sql(c)} AS {c}" for c in fe.FEATURES)


def features(t: Tables, admissions=None):
    return fe.admission_features(
        t.admissions if admissions is None else admissions, t.patients, t.diagnoses, t.prescriptions, t.procedures, t.labs, t.entity_counts
    )


@query("admission_features", with_ctes("feat", f"SELECT hadm_id, {_FEATURE_SQL} FROM feat"))
def _(t: Tables):
    return features(t).select("hadm_id", *[q(F.col(c)).alias(c) for c in fe.FEATURES])


@query(
    "feature_stats",
    with_ctes(
        "feat",
        " UNION ALL ".join(
            f"SELECT '{c}' AS feature, {q_sql(f'avg({c})')} AS mean, {q_sql(f'stddev_pop({c})')} AS std FROM feat"
            for c in fe.FEATURES
        ),
    ),
)
def _(t: Tables):
    stats = fe.feature_stats(features(t), fe.FEATURES)
    return stats.select("feature", q(F.col("mean")).alias("mean"), q(F.col("std")).alias("std"))


STANDARDIZED_SQL = "SELECT hadm_id, " + ", ".join(
    f"({c} - (SELECT avg({c}) FROM feat)) / coalesce(nullif((SELECT stddev_pop({c}) FROM feat), 0), 1) AS {c}"
    for c in fe.FEATURES
) + " FROM feat"


def standardized(t: Tables):
    table = materialize(features(t), "features")
    return fe.fit_scaler(table, fe.FEATURES).transform(table)


@query("standardized", with_ctes("feat", f"SELECT hadm_id, {_FEATURE_SQL} FROM ({STANDARDIZED_SQL})"))
def _(t: Tables):
    return standardized(t).select("hadm_id", *[q(F.col(c)).alias(c) for c in fe.FEATURES])


@query(
    "patient_feature",
    with_ctes(
        "pat",
        "SELECT subject_id, "
        + q_sql("(anchor_age - (SELECT avg(anchor_age) FROM pat)) / (SELECT stddev_pop(anchor_age) FROM pat)")
        + " AS anchor_age FROM pat",
    ),
)
def _(t: Tables):
    return fe.patient_features(t.patients).select("subject_id", q(F.col("anchor_age")).alias("anchor_age"))


@query(
    "feature_density",
    with_ctes(
        "feat",
        "SELECT "
        + q_sql("sum(" + " + ".join(f"({c} <> 0)::INTEGER" for c in fe.FEATURES) + f") / (count(*) * {len(fe.FEATURES)})", 6)
        + " AS density FROM feat",
    ),
)
def _(t: Tables):
    return fe.nonzero_fraction(features(t), fe.FEATURES).select(q(F.col("density"), 6).alias("density"))


@query("label_counts", with_ctes("adm", "SELECT hospital_expire_flag AS label, count(*) AS n FROM adm GROUP BY 1"))
def _(t: Tables):
    return ag.group_counts(fe.labels(t.admissions), "label")


@query(
    "class_weights",
    with_ctes(
        "adm",
        """SELECT hadm_id, hospital_expire_flag AS label, CASE WHEN hospital_expire_flag = 1 THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END AS weight
           FROM adm""",
    ),
)
def _(t: Tables):
    return mo.with_class_weights(fe.labels(t.admissions))


# ---- ranking, indexing, splits


@query(
    "dense_index",
    "SELECT l_orderkey, dense_rank() OVER (ORDER BY l_orderkey) - 1 AS idx FROM (SELECT DISTINCT l_orderkey FROM lineitem)",
)
def _(t: Tables):
    return rk.dense_index(t.scan("lineitem", "l_orderkey"), "l_orderkey")


@query(
    "dense_index_text",
    with_ctes("codes", "SELECT icd_code, row_number() OVER (ORDER BY icd_code) - 1 AS idx FROM (SELECT DISTINCT diag AS icd_code FROM codes)"),
)
def _(t: Tables):
    return rk.dense_index(t.diagnoses_raw, "icd_code")


@query(
    "category_codes",
    with_ctes(
        "adm_raw",
        "SELECT hadm_id, "
        + ", ".join(
            f"(dense_rank() OVER (ORDER BY coalesce({c}, 'UNKNOWN')) - 1)::BIGINT AS {c}_enc" for c in fe.CATEGORIES
        )
        + " FROM adm_raw",
    ),
)
def _(t: Tables):
    coded = rk.category_codes(t.admissions_raw.select("hadm_id", *fe.CATEGORIES), fe.CATEGORIES)
    return coded.select("hadm_id", *[F.col(f"{c}_enc").cast("bigint").alias(f"{c}_enc") for c in fe.CATEGORIES])


_RANKED_ORDERS = """SELECT o_orderkey, count(*) OVER () AS n,
    row_number() OVER (ORDER BY md5(o_orderkey || '|42'), o_orderkey) AS rn FROM orders"""


@query(
    "split_exact",
    f"""SELECT o_orderkey, CASE WHEN rn <= floor(0.8 * n) THEN 'train' WHEN rn <= floor(0.9 * n) THEN 'val'
        ELSE 'test' END AS split FROM ({_RANKED_ORDERS})""",
)
def _(t: Tables):
    return rk.split_exact(t.scan("orders", "o_orderkey"), "o_orderkey")


@query(
    "split_hash",
    # cccccccd and e6666667 are 80 and 90 percent of the 32-bit range, rounded up.
    """SELECT o_orderkey, CASE WHEN h < 'cccccccd' THEN 'train' WHEN h < 'e6666667' THEN 'val' ELSE 'test' END AS split
       FROM (SELECT o_orderkey, substr(md5(o_orderkey || '|42'), 1, 8) AS h FROM orders)""",
)
def _(t: Tables):
    return rk.split_hash(t.scan("orders", "o_orderkey"), "o_orderkey")


@query(
    "undersample",
    with_ctes(
        "adm",
        """SELECT hadm_id, label FROM (SELECT hadm_id, hospital_expire_flag AS label,
             row_number() OVER (PARTITION BY hospital_expire_flag ORDER BY md5(hadm_id || '|42'), hadm_id) AS rn FROM adm)
           WHERE label = 1 OR rn <= 2 * (SELECT sum(hospital_expire_flag) FROM adm)""",
    ),
)
def _(t: Tables):
    return rk.undersample(fe.labels(t.admissions), "hadm_id", "label")


@query("default_case", with_ctes("emb_split", "SELECT min(vec_id) AS hadm_id FROM emb_split WHERE split = 'test'"))
def _(t: Tables):
    return rk.first_in_split(rk.split_exact(t.embeddings.select("hadm_id"), "hadm_id"), "hadm_id")


# ---- label expressions


@query(
    "risk_label",
    """SELECT o_orderkey, CASE WHEN p >= 0.5 THEN 'HIGH' ELSE 'LOW' END || ' MORTALITY RISK (confidence: '
       || printf('%.1f', p * 100) || '%)' AS prediction FROM (SELECT o_orderkey, (o_totalprice % 1000) / 1000 AS p FROM orders)""",
)
def _(t: Tables):
    prob = (F.col("o_totalprice") % 1000) / 1000
    return t.scan("orders", "o_orderkey", "o_totalprice").select("o_orderkey", sc.risk_label(prob).alias("prediction"))


@query(
    "softmax2",
    f"""SELECT c_custkey, {q_sql('1 / (1 + exp(l0 - l1))', 6)} AS prob, (l1 > l0)::INTEGER AS pred
        FROM (SELECT c_custkey, c_acctbal / 5000 AS l0, c_nationkey / 12.5::DOUBLE AS l1 FROM customer)""",
)
def _(t: Tables):
    l0, l1 = F.col("c_acctbal") / 5000, F.col("c_nationkey") / F.lit(12.5)
    return t.scan("customer", "c_custkey", "c_acctbal", "c_nationkey").select(
        "c_custkey", q(sc.softmax2(l0, l1), 6).alias("prob"), sc.argmax2(l0, l1).alias("pred")
    )


@query(
    "timestamp_parse",
    # Texts of three shapes: with a fraction, with seconds only, and one that is no timestamp.
    """SELECT event_id, CASE WHEN event_id % 7 = 3 THEN NULL WHEN event_id % 2 = 0 THEN ts ELSE date_trunc('second', ts) END AS ts
       FROM events""",
)
def _(t: Tables):
    ts, number = F.col("ts"), F.col("event_id")
    text = (
        F.when(number % 7 == 3, F.concat(F.lit("no time "), F.col("event_type")))
        .when(number % 2 == 0, F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
    )
    return t.scan("events", "event_id", "ts", "event_type").select("event_id", sc.parse_timestamp(text, "null").alias("ts"))
