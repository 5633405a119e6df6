"""Nodes, edges, validation, propagation."""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from casegraph.functions.scalars import hours_between
from casegraph.functions.vectors import greatest_vector, zeros
from casegraph.operators import cohort as co
from casegraph.operators import features as fe
from casegraph.operators import graph as gr
from casegraph.operators import id_registry as ids
from casegraph.operators import propagate as pr
from casegraph.operators import ranking as rk
from casegraph.plans import stages
from casegraph.session import at_once, materialize, new_folder
from casegraph.sources import sinks
from workload.cohort_queries import STANDARDIZED_SQL, standardized
from workload.registry import joined, q, q_sql, query
from workload.tables import Tables, with_ctes


def graph(t: Tables, **options) -> gr.CaseGraph:
    admissions = materialize(t.admissions, "admissions")
    # distinct codes as in the tables, found where the graph wants them
    diagnoses, procedures = (co.distinct_rows(gr.by_admission(rows)) for rows in (t.diagnoses_raw, t.procedures_raw))
    return gr.build_graph(admissions, t.patients, diagnoses, procedures, t.prescriptions, t.labs, t.entities, **options)


_KNOWN = "WHERE hadm_id IN (SELECT hadm_id FROM adm)"
_NODE_SQL = {
    "Patient": """SELECT DISTINCT a.subject_id, gender, anchor_age FROM adm a LEFT JOIN pat p ON a.subject_id = p.subject_id""",
    "Admission": "SELECT hadm_id FROM adm",
    "Diagnosis": f"SELECT icd_code, min(icd_version) AS icd_version FROM diag {_KNOWN} GROUP BY icd_code",
    "Medication": f"SELECT DISTINCT drug FROM presc {_KNOWN}",
    "Procedure": f"SELECT icd_code, min(icd_version) AS icd_version FROM proc {_KNOWN} GROUP BY icd_code",
    "LabTest": f"SELECT DISTINCT itemid FROM labs {_KNOWN}",
}
_EDGE_SQL = {
    "HAS_ADMISSION": "SELECT DISTINCT subject_id, hadm_id FROM adm",
    "DIAGNOSED_WITH": f"SELECT DISTINCT hadm_id, icd_code FROM diag {_KNOWN}",
    "PRESCRIBED": f"SELECT DISTINCT hadm_id, drug, starttime FROM presc {_KNOWN}",
    "HAS_PROCEDURE": f"SELECT DISTINCT hadm_id, icd_code FROM proc {_KNOWN}",
    "HAS_LAB": "SELECT hadm_id, itemid FROM lab_edge",
}
_ALL = "adm pat diag proc presc labs lab_edge"
_LONG_SQL = " UNION ALL ".join(
    f"""SELECT '{name}' AS edge_type, {gr.NODE_KEYS[gr.EDGE_ENDS[name][0]]}::VARCHAR AS src,
        {gr.NODE_KEYS[gr.EDGE_ENDS[name][1]]}::VARCHAR AS dst FROM ({sql})"""
    for name, sql in _EDGE_SQL.items()
)


def merged_graph(t: Tables) -> gr.CaseGraph:
    """The graph of all cases, merged from those with even and then those with odd numbers."""
    folder = new_folder(t.spark, "merged-graph")
    admissions = materialize(t.admissions, "admissions")
    for odd in (0, 1):
        batch = admissions.where(F.col("hadm_id") % 2 == odd)
        # the graph makes the codes distinct
        found = gr.build_graph(batch, t.patients, t.diagnoses_raw, t.procedures_raw, t.prescriptions, t.labs, deal=False)
        stages.merge_graph(found, folder, 8)
    return stages.read_graph(t.spark, folder)


@query("merged_edges", with_ctes("adm diag proc presc labs lab_edge", _LONG_SQL))
def _(t: Tables):
    return gr.long_edges(merged_graph(t).edges)


@query(
    "merged_diagnoses",
    # the version that the first batch wrote stays
    with_ctes(
        "adm diag",
        f"""SELECT icd_code, coalesce(min(icd_version) FILTER (hadm_id % 2 = 0), min(icd_version)) AS icd_version
            FROM diag {_KNOWN} GROUP BY icd_code""",
    ),
)
def _(t: Tables):
    return merged_graph(t).nodes["Diagnosis"]


@query(
    "stable_index",
    # drugs of even cases first, behind them those that only odd cases have
    with_ctes(
        "presc",
        """SELECT drug, row_number() OVER (ORDER BY batch, drug) - 1 AS idx, batch FROM
           (SELECT drug, min(CASE WHEN hadm_id % 2 = 0 THEN 1 ELSE 2 END) AS batch FROM presc WHERE drug IS NOT NULL GROUP BY drug)""",
    ),
)
def _(t: Tables):
    folder = new_folder(t.spark, "drug-index")
    for odd in (0, 1):
        ids.extend_index(t.prescriptions.where(F.col("hadm_id") % 2 == odd), "drug", folder, 8)
    return ids.read_index(t.spark, "drug", folder)


@query(
    "stable_admission_index",
    with_ctes(
        "adm",
        """SELECT hadm_id, row_number() OVER (ORDER BY hadm_id % 2, hadm_id) - 1 AS idx, (hadm_id % 2 + 1)::INTEGER AS batch
           FROM (SELECT DISTINCT hadm_id FROM adm)""",
    ),
)
def _(t: Tables):
    folder = new_folder(t.spark, "admission-index")
    admissions = materialize(t.admissions.select("hadm_id"), "admissions")
    for batch in (admissions.where("hadm_id % 2 = 0"), admissions, admissions.where("hadm_id % 2 = 0")):
        ids.extend_index(batch, "hadm_id", folder, 8)
    return ids.read_index(t.spark, "hadm_id", folder)


@query(
    "merged_case_results",
    # the second run covers even cases and replaces their first result
    with_ctes(
        "adm",
        """SELECT hadm_id, CASE WHEN hadm_id % 2 = 0 THEN insurance ELSE admission_type END AS answer,
                  CASE WHEN hadm_id % 2 = 0 THEN 2 ELSE 1 END AS run FROM adm""",
    ),
)
def _(t: Tables):
    path = new_folder(t.spark, "results")
    admissions = materialize(t.admissions.select("hadm_id", "admission_type", "insurance"), "admissions")
    first = admissions.select("hadm_id", F.col("admission_type").alias("answer"), F.lit(1).alias("run"))
    second = admissions.where("hadm_id % 2 = 0").select("hadm_id", F.col("insurance").alias("answer"), F.lit(2).alias("run"))
    sinks.merge_case_results(first, path, rows_per_bucket=5_000)
    sinks.merge_case_results(second, path)
    return sinks.read_cases(t.spark, path)


@query("nodes_patient", with_ctes("adm pat", _NODE_SQL["Patient"]))
def _(t: Tables):
    return gr.patient_nodes(t.admissions, t.patients)


@query(
    "nodes_admission",
    with_ctes("adm", f"SELECT * EXCLUDE (subject_id, los_hours), {q_sql('los_hours')} AS los_hours FROM adm"),
)
def _(t: Tables):
    return gr.admission_nodes(t.admissions).withColumn("los_hours", q(F.col("los_hours")))


@query("nodes_diagnosis", with_ctes("adm diag", _NODE_SQL["Diagnosis"]))
def _(t: Tables):
    return gr.code_nodes(t.diagnoses_raw, t.admissions)


@query("nodes_diagnosis_versioned", with_ctes("adm diag", f"SELECT DISTINCT icd_code, icd_version FROM diag {_KNOWN}"))
def _(t: Tables):
    return gr.code_nodes(t.diagnoses_raw, t.admissions, versioned=True)


@query("nodes_medication", with_ctes("adm presc", _NODE_SQL["Medication"]))
def _(t: Tables):
    return gr.item_nodes(gr.fact_edges(t.prescriptions, t.admissions, "drug", ("starttime",)), "drug")


@query("nodes_procedure", with_ctes("adm proc", _NODE_SQL["Procedure"]))
def _(t: Tables):
    return gr.code_nodes(t.procedures_raw, t.admissions)


@query("nodes_labtest", with_ctes("adm labs", _NODE_SQL["LabTest"]))
def _(t: Tables):
    return gr.item_nodes(gr.lab_edges(t.labs, t.admissions), "itemid")


@query("edge_has_admission", with_ctes("adm", _EDGE_SQL["HAS_ADMISSION"]))
def _(t: Tables):
    return gr.has_admission_edges(t.admissions)


@query("edge_diagnosed", with_ctes("adm diag", _EDGE_SQL["DIAGNOSED_WITH"]))
def _(t: Tables):
    return gr.fact_edges(t.diagnoses_raw, t.admissions, "icd_code")


@query("edge_prescribed", with_ctes("adm presc", _EDGE_SQL["PRESCRIBED"]))
def _(t: Tables):
    return gr.fact_edges(t.prescriptions, t.admissions, "drug", ("starttime",))


@query("edge_procedure", with_ctes("adm proc", _EDGE_SQL["HAS_PROCEDURE"]))
def _(t: Tables):
    return gr.fact_edges(t.procedures_raw, t.admissions, "icd_code")


@query("edge_procedure_rows", with_ctes("adm codes", f"SELECT hadm_id, proc AS icd_code FROM codes {_KNOWN}"))
def _(t: Tables):
    return gr.fact_edges(t.procedures_raw, t.admissions, "icd_code", multiplicity="row")


@query(
    "edge_has_lab",
    with_ctes(
        "lab_edge",
        f"SELECT hadm_id, itemid, {q_sql('mean_value')} AS mean_value, {q_sql('std_value')} AS std_value FROM lab_edge",
    ),
)
def _(t: Tables):
    edges = gr.lab_edges(t.labs, t.admissions)
    return edges.select("hadm_id", "itemid", q(F.col("mean_value")).alias("mean_value"), q(F.col("std_value")).alias("std_value"))


@query(
    "edge_index",
    with_ctes(
        "adm presc",
        """SELECT a.idx AS src_idx, m.idx AS dst_idx FROM presc p
           JOIN (SELECT hadm_id, row_number() OVER (ORDER BY hadm_id) - 1 AS idx FROM adm) a ON p.hadm_id = a.hadm_id
           JOIN (SELECT drug, row_number() OVER (ORDER BY drug) - 1 AS idx FROM (SELECT DISTINCT drug FROM presc)) m
             ON p.drug = m.drug""",
    ),
)
def _(t: Tables):
    return gr.indexed_edges(
        t.prescriptions, "hadm_id", rk.dense_index(t.admissions, "hadm_id"), "drug", rk.dense_index(t.prescriptions, "drug")
    )


# Edge type, its rows, and the columns of its ends.
_INDEXED = [
    ("HAS_ADMISSION", "adm", "subject_id", "hadm_id"), ("DIAGNOSED_WITH", "diag", "hadm_id", "icd_code"),
    ("PRESCRIBED", "presc", "hadm_id", "drug"), ("HAS_PROCEDURE", "proc", "hadm_id", "icd_code"),
    ("HAS_LAB", "(SELECT DISTINCT hadm_id, itemid FROM labs)", "hadm_id", "itemid"),
]


def _index_sql(key: str, rows: str) -> str:
    return f"(SELECT {key}, row_number() OVER (ORDER BY {key}) - 1 AS idx FROM (SELECT DISTINCT {key} FROM {rows}))"


@query(
    "edge_index_all",
    with_ctes(
        "adm diag presc proc labs",
        " UNION ALL ".join(
            f"""SELECT '{name}' AS edge_type, a.idx AS src_idx, b.idx AS dst_idx FROM {rows} e
                JOIN {_index_sql(src, 'adm')} a ON e.{src} = a.{src}
                JOIN {_index_sql(dst, 'adm' if name == 'HAS_ADMISSION' else rows)} b ON e.{dst} = b.{dst}"""
            for name, rows, src, dst in _INDEXED
        ),
    ),
)
def _(t: Tables):
    admissions = materialize(t.admissions.select("hadm_id", "subject_id"), "admissions")
    tables = {"DIAGNOSED_WITH": t.diagnoses, "PRESCRIBED": t.prescriptions, "HAS_PROCEDURE": t.procedures, "HAS_LAB": gr.lab_pairs(t.labs)}

    def stored(name: str, item: str):
        rows = materialize(tables[name].select("hadm_id", item), "edge-rows")
        return rows, rk.dense_index(rows, item)

    jobs = [lambda key=key: rk.dense_index(admissions, key) for key in ("hadm_id", "subject_id")]
    index, patients, *items = at_once([*jobs, *(lambda name=name, item=item: stored(name, item) for name, _, _, item in _INDEXED[1:])])
    found = {"HAS_ADMISSION": gr.indexed_edges(admissions, "subject_id", patients, "hadm_id", index)}
    for (name, _, _, item), (rows, item_index) in zip(_INDEXED[1:], items):
        found[name] = gr.indexed_edges(rows, "hadm_id", index, item, item_index)
    typed = [edges.select(F.lit(name).alias("edge_type"), "src_idx", "dst_idx") for name, edges in found.items()]
    return functools.reduce(lambda a, b: a.unionByName(b), typed)


@query("edges_long", with_ctes(_ALL, _LONG_SQL))
def _(t: Tables):
    return gr.long_edges(graph(t).edges)


@query(
    "edges_undirected",
    with_ctes(
        _ALL,
        "SELECT * FROM e UNION ALL SELECT 'rev_' || edge_type, dst, src FROM e",
        e=_LONG_SQL,
    ),
)
def _(t: Tables):
    return gr.undirected(gr.long_edges(graph(t).edges))


@query("node_degree", with_ctes(_ALL, "SELECT edge_type, src, count(*) AS degree FROM e GROUP BY ALL", e=_LONG_SQL))
def _(t: Tables):
    return gr.node_degree(gr.long_edges(graph(t).edges))


@query(
    "graph_stats",
    with_ctes(
        _ALL,
        " UNION ALL ".join(
            [f"SELECT 'node' AS kind, '{n}' AS type, count(*) AS n FROM ({sql})" for n, sql in _NODE_SQL.items()]
            + [f"SELECT 'edge', '{n}', count(*) FROM ({sql})" for n, sql in _EDGE_SQL.items()]
        ),
    ),
)
def _(t: Tables):
    return gr.graph_stats(graph(t, write=materialize))


@query(
    "admission_enriched",
    with_ctes(
        "adm clean_sets",
        "SELECT a.hadm_id, admission_type, "
        + ", ".join(f"array_to_string({c}, '|') AS extracted_{c}" for c in ("symptoms", "diseases", "medications"))
        + " FROM adm a LEFT JOIN clean_sets s ON a.hadm_id = s.hadm_id",
    ),
)
def _(t: Tables):
    nodes = gr.enrich_admissions(gr.admission_nodes(t.admissions), t.entities)
    lists = [f"extracted_{c}" for c in ("symptoms", "diseases", "medications")]
    return nodes.select("hadm_id", "admission_type", *[joined(F.col(c)).alias(c) for c in lists])


# ---- validation, on a graph with gaps: patient edges of adults only, codes of all rows,
# code edges of admissions with a note, and stays of any sign


def graph_with_gaps(t: Tables) -> gr.CaseGraph:
    noted = co.restrict(t.admissions, co.cohort_ids(t.notes, "hadm_id"), "hadm_id")
    stays = t.admissions_raw.withColumn("los_hours", hours_between(F.col("admittime"), F.col("dischtime")))
    return gr.CaseGraph(
        nodes={
            "Admission": gr.admission_nodes(stays),
            "Diagnosis": gr.code_nodes(t.diagnoses_raw, None),
            "Procedure": gr.code_nodes(t.procedures_raw, None),
        },
        edges={
            "HAS_ADMISSION": gr.has_admission_edges(co.restrict(t.admissions_raw, t.patients, "subject_id")),
            "DIAGNOSED_WITH": gr.fact_edges(t.diagnoses_raw, noted, "icd_code"),
            "HAS_PROCEDURE": gr.fact_edges(t.procedures_raw, noted, "icd_code"),
        },
    )


_NOTED = "(SELECT hadm_id FROM adm WHERE hadm_id IN (SELECT doc_id FROM documents))"
_CHECKS = {
    "check_orphan_admission": (gr.ORPHAN_ADMISSIONS, gr.orphan_admissions,
        "SELECT count(*) AS n FROM adm_raw WHERE subject_id NOT IN (SELECT subject_id FROM pat)"),
    "check_orphan_diagnosis": (gr.ORPHAN_DIAGNOSES, gr.orphan_diagnoses,
        f"""SELECT count(DISTINCT icd_code) AS n FROM diag WHERE icd_code NOT IN
            (SELECT icd_code FROM diag WHERE hadm_id IN {_NOTED})"""),
    "check_orphan_procedure": (gr.ORPHAN_PROCEDURES, gr.orphan_procedures,
        f"""SELECT count(DISTINCT icd_code) AS n FROM proc WHERE icd_code NOT IN
            (SELECT icd_code FROM proc WHERE hadm_id IN {_NOTED})"""),
    "check_negative_los": (gr.NEGATIVE_STAYS, gr.negative_stays,
        "SELECT count(*) AS n FROM adm_raw WHERE dischtime < admittime"),
}


def _check_sql(name: str, count_sql: str) -> str:
    return f"""SELECT '{name}' AS "check", n AS "count",
               CASE WHEN n = 0 THEN 'OK' ELSE 'WARNING: ' || n || ' found' END AS status FROM ({count_sql})"""


for _name, (_title, _operator, _sql) in _CHECKS.items():
    query(_name, with_ctes("adm pat diag proc", _check_sql(_title, _sql)))(
        lambda t, operator=_operator: operator(graph_with_gaps(t))
    )


@query(
    "graph_validation",
    with_ctes(
        "adm pat diag proc",
        " UNION ALL ".join(
            [_check_sql(title, sql) for title, _, sql in _CHECKS.values()]
            + [_check_sql(f"Duplicate {n} keys", "SELECT 0 AS n") for n in ("Admission", "Diagnosis", "Procedure")]
        ),
    ),
)
def _(t: Tables):
    return gr.validate_graph(graph_with_gaps(t))


@query(
    "check_unique",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def _(t: Tables):
    return gr.duplicate_keys(t.scan("lineitem", "l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"])


# ---- vectors on edges


@query(
    "neighbor_mean",
    f"""SELECT l_suppkey AS dst, dim, {q_sql('avg(v)', 6)} AS value FROM lineitem JOIN
          (SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings)
          ON l_orderkey = vec_id GROUP BY ALL""",
)
def _(t: Tables):
    edges = t.scan("lineitem", "l_orderkey", "l_suppkey").toDF("src", "dst")
    means = pr.neighbour_means(edges, t.embeddings.toDF("id", "vector"), 64)
    rows = means.select("dst", F.posexplode("vector").alias("dim", "value"))
    return rows.select("dst", F.col("dim").cast("bigint").alias("dim"), q(F.col("value"), 6).alias("value"))


def _order_edges(t: Tables):
    lines = t.scan("lineitem", "l_orderkey", "l_partkey", "l_suppkey")
    parts = lines.select(F.col("l_partkey").alias("src"), F.col("l_orderkey").alias("dst"))
    suppliers = lines.select(F.col("l_suppkey").alias("src"), F.col("l_orderkey").alias("dst"))
    return parts, suppliers


def _vectors(t: Tables):
    part = t.scan("part", "p_partkey", "p_retailprice", "p_size").select(
        F.col("p_partkey").alias("id"), F.array(F.col("p_retailprice") / 1000, F.col("p_size") / 10.0).alias("vector")
    )
    supplier = t.scan("supplier", "s_suppkey", "s_acctbal", "s_nationkey").select(
        F.col("s_suppkey").alias("id"), F.array(F.col("s_acctbal") / 1000, F.col("s_nationkey") / 10.0).alias("vector")
    )
    order = t.scan("orders", "o_orderkey", "o_totalprice").select(
        F.col("o_orderkey").alias("id"), F.array(F.col("o_totalprice") / 100000, F.lit(1.0)).alias("vector")
    )
    return part, supplier, order


_HOP_SQL = """SELECT o_orderkey AS hadm_id, o_totalprice / 100000 AS x0, 1.0::DOUBLE AS x1, coalesce(p0, 0) AS p0, coalesce(p1, 0) AS p1,
      coalesce(s0, 0) AS s0, coalesce(s1, 0) AS s1 FROM orders LEFT JOIN
      (SELECT l_orderkey, avg(p_retailprice / 1000) AS p0, avg(p_size / 10.0::DOUBLE) AS p1, avg(s_acctbal / 1000) AS s0,
         avg(s_nationkey / 10.0::DOUBLE) AS s1
       FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_orderkey)
      ON o_orderkey = l_orderkey"""


@query(
    "hetero_max",
    f"SELECT hadm_id, {q_sql('greatest(p0, s0)')} AS h0, {q_sql('greatest(p1, s1)')} AS h1 FROM ({_HOP_SQL})",
)
def _(t: Tables):
    (part_edges, supplier_edges), (part, supplier, order) = _order_edges(t), _vectors(t)
    by_part = pr.neighbour_means(part_edges, part, 2).toDF("id", "p")
    by_supplier = pr.neighbour_means(supplier_edges, supplier, 2).toDF("id", "s")
    both = order.select("id").join(by_part, "id", "left").join(by_supplier, "id", "left")
    best = greatest_vector(F.coalesce("p", zeros(2)), F.coalesce("s", zeros(2)))
    return both.select(F.col("id").alias("hadm_id"), best.alias("h")).select(
        "hadm_id", q(F.col("h")[0]).alias("h0"), q(F.col("h")[1]).alias("h1")
    )


@query(
    "propagate_2hop",
    f"""WITH own AS (SELECT o_orderkey AS id, o_totalprice / 1000 AS x FROM orders),
        pairs AS (SELECT DISTINCT l_orderkey AS id, l_partkey AS item FROM lineitem),
        items AS (SELECT item, avg(x) AS x FROM pairs JOIN own USING (id) GROUP BY item),
        back AS (SELECT id, avg(x) AS x FROM pairs JOIN items USING (item) GROUP BY id)
        SELECT own.id AS hadm_id, {q_sql('own.x')} AS own, {q_sql('coalesce(back.x, 0)')} AS shared FROM own LEFT JOIN back USING (id)""",
)
def _(t: Tables):
    own = t.scan("orders", "o_orderkey", "o_totalprice").select(
        F.col("o_orderkey").alias("hadm_id"), F.array(F.col("o_totalprice").cast("double") / 1000).alias("features")
    )
    pairs = t.scan("lineitem", "l_orderkey", "l_partkey").toDF("case", "item").distinct()
    wide = pr.neighbourhood_features(own, {"OF_PART": materialize(pairs, "pairs")}, 1)
    return wide.select("hadm_id", q(F.col("features")[0]).alias("own"), q(F.col("features")[1]).alias("shared"))


# Small weights that are exact in binary.
_PART_W, _PART_B, _PART_R = [[0.5, -0.25], [0.25, 1.0]], [0.125, -0.5], [[1.0, 0.5], [-0.5, 0.25]]
_SUPP_W, _SUPP_B, _SUPP_R = [[-0.5, 0.75], [1.0, 0.125]], [0.25, 0.0], [[0.25, -1.0], [0.5, 0.5]]


def _message_sql(x: str, w, b, r, out: int) -> str:
    return f"{x}0 * {w[0][out]} + {x}1 * {w[1][out]} + {b[out]} + x0 * {r[0][out]} + x1 * {r[1][out]}"


@query(
    "propagate_1hop",
    "SELECT hadm_id, "
    + ", ".join(
        q_sql(
            f"greatest(0, greatest({_message_sql('p', _PART_W, _PART_B, _PART_R, o)}, "
            f"{_message_sql('s', _SUPP_W, _SUPP_B, _SUPP_R, o)}))"
        )
        + f" AS h{o}"
        for o in (0, 1)
    )
    + f" FROM ({_HOP_SQL})",
)
def _(t: Tables):
    (part_edges, supplier_edges), (part, supplier, order) = _order_edges(t), _vectors(t)
    result = pr.hetero_layer(
        {"Admission": order, "Part": part, "Supplier": supplier},
        {("Part", "OF_PART", "Admission"): part_edges, ("Supplier", "OF_SUPPLIER", "Admission"): supplier_edges},
        {
            "OF_PART": pr.Convolution(pr.Affine(_PART_W, _PART_B), _PART_R),
            "OF_SUPPLIER": pr.Convolution(pr.Affine(_SUPP_W, _SUPP_B), _SUPP_R),
        },
        dim=2,
    )["Admission"]
    return result.select(
        F.col("id").alias("hadm_id"), q(F.col("vector")[0]).alias("h0"), q(F.col("vector")[1]).alias("h1")
    )


_EMBED_W = [[((i * 7 + j * 3) % 5 - 2) / 4 for j in range(4)] for i in range(len(fe.FEATURES))]
_EMBED_B = [0.5, -0.5, 0.25, 0.0]
_EMBED_NORM = pr.Norm(mean=[0.5, 0.0, -0.5, 0.25], var=[4.0, 1.0, 0.25, 16.0], gamma=[1.0, 0.5, 2.0, 1.0], beta=[0.0, 1.0, -1.0, 0.5], eps=0.0)


def _embedding_sql(j: int) -> str:
    linear = " + ".join(f"{c} * ({_EMBED_W[i][j]})" for i, c in enumerate(fe.FEATURES))
    n = _EMBED_NORM
    return q_sql(f"({linear} + {_EMBED_B[j]} - ({n.mean[j]})) / sqrt({n.var[j]}::DOUBLE) * {n.gamma[j]} + ({n.beta[j]})")


@query(
    "feature_embedding",
    with_ctes("feat", "SELECT hadm_id, " + ", ".join(f"{_embedding_sql(j)} AS e{j}" for j in range(4)) + f" FROM ({STANDARDIZED_SQL})"),
)
def _(t: Tables):
    vectors = standardized(t).select("hadm_id", F.array(*fe.FEATURES).alias("features"))
    embedded = pr.embed(vectors, pr.Affine(_EMBED_W, _EMBED_B), _EMBED_NORM)
    return embedded.select("hadm_id", *[q(F.col("embedding")[j]).alias(f"e{j}") for j in range(4)])
