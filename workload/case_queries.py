"""Prediction, evaluation, retrieval and rendering."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegraph.functions.vectors import squared_l2
from casegraph.operators import context as cx
from casegraph.operators import entities as en
from casegraph.operators import features as fe
from casegraph.operators import knn
from casegraph.operators import metrics as me
from casegraph.operators import model as mo
from casegraph.operators import ranking as rk
from casegraph.operators import training as tr
from casegraph.operators import vector_index as vi
from casegraph.plans import stages
from casegraph.session import materialize, new_folder
from workload.cohort_queries import features
from workload.graph_queries import graph
from workload.registry import joined, q, q_sql, query
from workload.tables import Tables, with_ctes

# ---- evaluation

_SCORED = "(SELECT doc_id, toxic AS label, (doc_id * 37 % 101) / 101.0::DOUBLE AS prob FROM labels)"
_AUC_SQL = f"""(SELECT sum(CASE WHEN p.prob > n.prob THEN 1.0::DOUBLE WHEN p.prob = n.prob THEN 0.5 ELSE 0 END) / count(*) AS auc
    FROM {_SCORED} p, {_SCORED} n WHERE p.label = 1 AND n.label = 0)"""
_CELLS_SQL = f"""(SELECT count(*) FILTER (label = 1 AND prob >= 0.5) AS tp, count(*) FILTER (label = 0 AND prob >= 0.5) AS fp,
    count(*) FILTER (label = 1 AND prob < 0.5) AS fn, count(*) FILTER (label = 0 AND prob < 0.5) AS tn FROM {_SCORED})"""


def _with_pred(t: Tables):
    return t.scored.withColumn("pred", (F.col("prob") >= 0.5).cast("int"))


@query("metric_auc", f"SELECT {q_sql('auc', 6)} AS auc FROM {_AUC_SQL}")
def _(t: Tables):
    return me.auc(t.scored).select(q(F.col("auc"), 6).alias("auc"))


@query(
    "metric_prf",
    f"""SELECT {q_sql('tp / nullif(tp + fp, 0)', 6)} AS precision, {q_sql('tp / nullif(tp + fn, 0)', 6)} AS recall,
        {q_sql('2 * tp / nullif(2 * tp + fp + fn, 0)', 6)} AS f1 FROM {_CELLS_SQL}""",
)
def _(t: Tables):
    row = me.precision_recall_f1(_with_pred(t))
    return row.select(*[q(F.col(c), 6).alias(c) for c in ("precision", "recall", "f1")])


@query(
    "metric_confusion",
    f"""SELECT 0 AS label, 0 AS pred, tn AS n FROM {_CELLS_SQL} UNION ALL SELECT 0, 1, fp FROM {_CELLS_SQL}
        UNION ALL SELECT 1, 0, fn FROM {_CELLS_SQL} UNION ALL SELECT 1, 1, tp FROM {_CELLS_SQL}""",
)
def _(t: Tables):
    return me.confusion_matrix(_with_pred(t))


@query(
    "metric_report",
    f"""SELECT 'auc' AS metric, {q_sql('auc', 6)} AS value FROM {_AUC_SQL}
        UNION ALL SELECT 'f1', {q_sql('2 * tp / nullif(2 * tp + fp + fn, 0)', 6)} FROM {_CELLS_SQL}
        UNION ALL SELECT 'precision', {q_sql('tp / nullif(tp + fp, 0)', 6)} FROM {_CELLS_SQL}
        UNION ALL SELECT 'recall', {q_sql('tp / nullif(tp + fn, 0)', 6)} FROM {_CELLS_SQL}""",
)
def _(t: Tables):
    return me.metric_report(t.scored).withColumn("value", q(F.col("value"), 6))


# ---- trained model


def evaluated(t: Tables) -> stages.Evaluation:
    """The whole run: all features and neighbourhoods, trained, chosen and tested."""
    tables = stages.written(
        stages.CaseTables(t.admissions, t.patients, t.diagnoses, t.procedures, t.labs, t.prescriptions, t.notes)
    )
    entities = stages.extract_entities(tables, lambda notes: en.dictionary_mentions(notes, t.dictionary))
    return stages.train_and_evaluate(stages.build_training_graph(tables, entities))


@query(
    "class_rate_model",
    # Without regularisation on the one-hot insurance, the optimum is the weighted rate of each insurance.
    with_ctes(
        "adm",
        f"""SELECT insurance, {q_sql('1.5 * n1 / (1.5 * n1 + n0)', 3)} AS prob FROM (
              SELECT insurance, count(*) FILTER (label = 1) AS n1, count(*) FILTER (label = 0) AS n0 FROM balanced GROUP BY insurance)""",
        ranked="""SELECT hadm_id, insurance, hospital_expire_flag AS label, count(*) OVER () AS n,
                  row_number() OVER (ORDER BY md5(hadm_id || '|42'), hadm_id) AS rn FROM adm""",
        training="""SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(hadm_id || '|42'), hadm_id) AS place,
                    sum(label) OVER () AS positives FROM ranked WHERE rn <= floor(0.8 * n)""",
        balanced="SELECT * FROM training WHERE label = 1 OR place <= 2 * positives",
    ),
)
def _(t: Tables):
    groups = sorted(r["l_returnflag"] for r in t.scan("lineitem", "l_returnflag").distinct().collect())
    one_hot = F.array(*((F.col("insurance") == g).cast("double") for g in groups))
    rows = t.admissions.select("hadm_id", "insurance", F.col("hospital_expire_flag").alias("label"), one_hot.alias("features"))
    rows = materialize(rk.split_exact(rows, "hadm_id"), "insurance-examples")
    balanced = rk.undersample(rows.where("split = 'train'"), "hadm_id", "label")
    trained = mo.train(balanced, rows.where("split = 'val'"), reg_params=(0.0,), max_iter=300, tol=1e-12)
    predicted = mo.score(trained.model, balanced.select("insurance", "features").distinct())
    return predicted.select("insurance", q(F.col("prob"), 3).alias("prob"))


# Weights of the features in the order of ``fe.FEATURES``.
_WEIGHTS = (0.0001, 0.0005, 0.25, -0.125, 0.0625, 0.03, -0.05, 0.02, -0.04, -0.00001, 0.1, -0.2, 0.15)
_BIAS = -0.5
_MARGIN = f"{_BIAS} + " + " + ".join(f"({w}::DOUBLE) * {c}" for w, c in zip(_WEIGHTS, fe.FEATURES))


@query(
    "linear_scores",
    with_ctes(
        "feat",
        f"""SELECT hadm_id, {q_sql('p', 6)} AS prob, (p >= 0.5)::INTEGER AS pred
            FROM (SELECT hadm_id, 1 / (1 + exp(-({_MARGIN}))) AS p FROM feat)""",
    ),
)
def _(t: Tables):
    rows = features(t).select("hadm_id", F.array(*fe.FEATURES).alias("features"))
    scored = mo.score(mo.LinearModel(_WEIGHTS, _BIAS), rows)
    return scored.select("hadm_id", q(F.col("prob"), 6).alias("prob"), "pred")


# The whole training: all epochs, with the step size halved when the validation area has not risen for long.
WHOLE = tr.Schedule()
# Few and large steps, whose SQL has a table for each.
SCHEDULE = tr.Schedule(epochs=6, learning_rate=0.1, every=2)


def epoch_training(t: Tables, schedule: tr.Schedule = WHOLE) -> tuple[tr.Trained, DataFrame]:
    """All 13 features, scaled by the training rows; balanced training rows, the best epoch by validation area."""
    # written once: their categories, features and labels are three uses
    admissions = materialize(t.admissions, "admissions")
    raw = materialize(features(t, admissions).join(fe.labels(admissions), "hadm_id"), "training-features")
    parted = rk.split_exact(raw, "hadm_id")
    scaler = fe.fit_scaler(parted.where("split = 'train'"), fe.FEATURES)
    rows = parted.select("hadm_id", "label", "split", F.array(*scaler.scaled()).alias("features"))
    rows = materialize(rows, "training-examples")
    balanced = rk.undersample(rows.where("split = 'train'"), "hadm_id", "label")
    return tr.train_epochs(balanced, rows.where("split = 'val'"), schedule), rows


def _zipped(a: str, b: str, body: str) -> str:
    return f"list_transform(list_zip({a}, {b}), lambda z: {body})"


_N_WEIGHTS = len(fe.FEATURES) + 1
_ZEROS = "[" + ", ".join(["0::DOUBLE"] * _N_WEIGHTS) + "]"


def _example_ctes() -> dict[str, str]:
    """Scaled features and labels, and the balanced training rows with their class weight."""
    scaled = ", ".join(f"(f.{c} - m_{c}) / coalesce(nullif(s_{c}, 0), 1)" for c in fe.FEATURES)
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in fe.FEATURES)
    return {
        "numbered": """SELECT f.*, a.hospital_expire_flag AS label, count(*) OVER () AS total,
            row_number() OVER (ORDER BY md5(f.hadm_id || '|42'), f.hadm_id) AS rn FROM feat f JOIN adm a ON f.hadm_id = a.hadm_id""",
        "parted": "SELECT *, CASE WHEN rn <= floor(0.8 * total) THEN 'train' WHEN rn <= floor(0.9 * total) THEN 'val' ELSE 'test' END AS split FROM numbered",
        "stats": f"SELECT {stats} FROM parted WHERE split = 'train'",
        "examples": f"SELECT f.hadm_id, label, split, [{scaled}, 1::DOUBLE] AS x FROM parted f, stats",
        "placed": """SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(hadm_id || '|42'), hadm_id) AS place,
            sum(label) OVER () AS positives FROM examples WHERE split = 'train'""",
        "balanced": "SELECT label, x, CASE WHEN label = 1 THEN 1.5::DOUBLE ELSE 1::DOUBLE END AS c FROM placed WHERE label = 1 OR place <= 2 * positives",
    }


def _training_ctes() -> dict[str, str]:
    """The same steps in SQL: a state of weights and moments (the intercept last) per epoch."""
    n, zipped = _N_WEIGHTS, _zipped
    margin = f"list_sum({zipped('x', 'w', 'z[1] * z[2]')})"
    ctes = _example_ctes() | {"s0": f"SELECT {_ZEROS} AS w, {_ZEROS} AS m, {_ZEROS} AS v"}
    evaluated = []
    for e in range(1, SCHEDULE.epochs + 1):
        sums = ", ".join(f"sum(c * (p - label) * x[{j}]) / sum(c)" for j in range(1, n + 1))
        ctes[f"g{e}"] = f"""SELECT [{sums}] AS g, -sum(c * ln(CASE WHEN label = 1 THEN p ELSE 1 - p END)) / sum(c) AS loss
            FROM (SELECT label, x, c, 1 / (1 + exp(-{margin})) AS p FROM balanced, s{e - 1})"""
        ctes[f"d{e}"] = f"SELECT w, m, v, {zipped('g', 'w', f'z[1] + {SCHEDULE.weight_decay}::DOUBLE * z[2]')} AS g FROM g{e}, s{e - 1}"
        ctes[f"u{e}"] = f"""SELECT w, {zipped('m', 'g', '0.9::DOUBLE * z[1] + (1 - 0.9::DOUBLE) * z[2]')} AS m,
            {zipped('v', 'g', '0.999::DOUBLE * z[1] + (1 - 0.999::DOUBLE) * z[2] * z[2]')} AS v FROM d{e}"""
        move = f"""{SCHEDULE.learning_rate}::DOUBLE * (z[1] / (1 - pow(0.9::DOUBLE, {e}))) / (sqrt(z[2] / (1 - pow(0.999::DOUBLE, {e}))) + 1e-8::DOUBLE)"""
        ctes[f"s{e}"] = f"SELECT {zipped('w', zipped('m', 'v', move), 'z[1] - z[2]')} AS w, m, v FROM u{e}"
        if e % SCHEDULE.every == 0:
            ctes[f"val{e}"] = f"SELECT label, 1 / (1 + exp(-{margin})) AS p FROM examples, s{e} WHERE split = 'val'"
            evaluated.append(
                f"""SELECT {e} AS epoch, loss, w, (SELECT sum(CASE WHEN a.p > b.p THEN 1::DOUBLE WHEN a.p = b.p THEN 0.5 ELSE 0 END) / count(*)
                    FROM val{e} a, val{e} b WHERE a.label = 1 AND b.label = 0) AS val_auc FROM g{e}, s{e}"""
            )
    ctes["evaluated"] = " UNION ALL ".join(evaluated)
    ctes["best"] = "SELECT w FROM evaluated ORDER BY coalesce(val_auc, 0) DESC, epoch LIMIT 1"
    return ctes


def _whole_training_sql(body: str) -> str:
    """``body`` after all epochs of the whole schedule: the state of an epoch is made of the one before."""
    s, sums = WHOLE, ", ".join(f"sum(c * (p - label) * x[{j}]) / sum(c)" for j in range(1, _N_WEIGHTS + 1))
    margin = "list_dot_product(x, w)"
    move = """rate * (z[1] / (1 - pow(0.9::DOUBLE, epoch))) / (sqrt(z[2] / (1 - pow(0.999::DOUBLE, epoch))) + 1e-8::DOUBLE)"""
    due = f"(stepped.epoch % {s.every} = 0 OR stepped.epoch = {s.epochs})"
    ctes = {
        "margins": f"SELECT epoch, label, x, c, 1 / (1 + exp(-{margin})) AS p FROM balanced, run WHERE epoch < {s.epochs}",
        "slope": f"""SELECT epoch, [{sums}] AS g, -sum(c * ln(CASE WHEN label = 1 THEN p ELSE 1 - p END)) / sum(c) AS loss
            FROM margins GROUP BY epoch""",
        "decayed": f"""SELECT run.* EXCLUDE (loss), slope.loss, {_zipped('g', 'w', f'z[1] + {s.weight_decay}::DOUBLE * z[2]')} AS g
            FROM run JOIN slope ON run.epoch = slope.epoch""",
        "moments": f"""SELECT * REPLACE (epoch + 1 AS epoch, {_zipped('m', 'g', '0.9::DOUBLE * z[1] + (1 - 0.9::DOUBLE) * z[2]')} AS m,
            {_zipped('v', 'g', '0.999::DOUBLE * z[1] + (1 - 0.999::DOUBLE) * z[2] * z[2]')} AS v) FROM decayed""",
        "stepped": f"SELECT * REPLACE ({_zipped('w', _zipped('m', 'v', move), 'z[1] - z[2]')} AS w) FROM moments",
        "due": f"SELECT epoch, w FROM stepped WHERE {due}",
        "scored": f"SELECT epoch, label, 1 / (1 + exp(-{margin})) AS p FROM held, due",
        "areas": """SELECT a.epoch, sum(CASE WHEN a.p > b.p THEN 1::DOUBLE WHEN a.p = b.p THEN 0.5 ELSE 0 END) / count(*) AS area
            FROM scored a JOIN scored b ON a.epoch = b.epoch AND a.label = 1 AND b.label = 0 GROUP BY a.epoch""",
        "judged": f"""SELECT stepped.*, {due} AS due, areas.area, coalesce(areas.area, 0) AS a,
            top IS NULL OR coalesce(areas.area, 0) > top AS better,
            plateau IS NULL OR coalesce(areas.area, 0) > plateau * (1 + 1e-4::DOUBLE) AS rose
            FROM stepped LEFT JOIN areas ON stepped.epoch = areas.epoch""",
    }
    step = f"""WITH {', '.join(f'{name} AS ({sql})' for name, sql in ctes.items())}
        SELECT epoch, w, m, v, CASE WHEN due AND NOT rose AND waited + 1 > {s.patience} THEN rate * {s.factor}::DOUBLE ELSE rate END AS rate,
        CASE WHEN due AND better THEN a ELSE top END AS top, CASE WHEN due AND rose THEN a ELSE plateau END AS plateau,
        CASE WHEN NOT due THEN waited WHEN rose OR waited + 1 > {s.patience} THEN 0 ELSE waited + 1 END AS waited,
        due AS seen, loss, area AS val_auc, better AS best FROM judged"""
    start = f"""SELECT 0 AS epoch, {_ZEROS} AS w, {_ZEROS} AS m, {_ZEROS} AS v, {s.learning_rate}::DOUBLE AS rate, NULL::DOUBLE AS top,
        NULL::DOUBLE AS plateau, 0 AS waited, FALSE AS seen, NULL::DOUBLE AS loss, NULL::DOUBLE AS val_auc, FALSE AS best"""
    made = _example_ctes() | {"held": "SELECT label, x FROM examples WHERE split = 'val'"}
    sql = with_ctes("adm feat", body, **made, run=f"{start} UNION ALL ({step})")
    for name in ("balanced", "held"):  # made once and not for each epoch
        sql = sql.replace(f", {name} AS (", f", {name} AS MATERIALIZED (", 1)
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


@query(
    "mortality_model",
    _whole_training_sql(f"SELECT epoch, {q_sql('loss', 6)} AS loss, {q_sql('val_auc', 6)} AS val_auc, best FROM run WHERE seen"),
)
def _(t: Tables):
    trained, _ = epoch_training(t)
    rows = t.spark.createDataFrame(trained.history, "epoch int, loss double, val_auc double, best boolean")
    return rows.select("epoch", q(F.col("loss"), 6).alias("loss"), q(F.col("val_auc"), 6).alias("val_auc"), "best")


@query(
    "predictions",
    with_ctes(
        "adm feat",
        f"""SELECT hadm_id, split, {q_sql('p', 6)} AS prob, (p >= 0.5)::INTEGER AS pred FROM
            (SELECT hadm_id, split, 1 / (1 + exp(-list_sum(list_transform(list_zip(x, w), lambda z: z[1] * z[2])))) AS p FROM examples, best)""",
        **_training_ctes(),
    ),
)
def _(t: Tables):
    trained, rows = epoch_training(t, SCHEDULE)
    scored = mo.score(trained.model, rows)
    return scored.select("hadm_id", "split", q(F.col("prob"), 6).alias("prob"), "pred")


# ---- retrieval


@query(
    "knn_exact",
    with_ctes(
        "emb_split near",
        f"""SELECT query_id, neighbor_id, rank::INTEGER AS rank, {q_sql('distance')} AS distance FROM near
            WHERE query_id = (SELECT min(vec_id) FROM emb_split WHERE split = 'test')""",
    ),
)
def _(t: Tables):
    case = rk.first_in_split(rk.split_exact(t.embeddings.select("hadm_id"), "hadm_id"), "hadm_id")
    asked = t.embeddings.join(case, "hadm_id", "left_semi")
    found = knn.nearest(asked, t.embeddings, 5, "hadm_id")
    return found.withColumn("distance", q(F.col("distance")))


@query(
    "knn_blocked", with_ctes("near", f"SELECT query_id, neighbor_id, rank::INTEGER AS rank, {q_sql('distance')} AS distance FROM near")
)
def _(t: Tables):
    found = knn.nearest(t.embeddings, t.embeddings, 5, "hadm_id", max_sent_queries=0)
    return found.withColumn("distance", q(F.col("distance")))


def _index(t: Tables) -> vi.VectorIndex:
    return vi.build_index(t.embeddings, new_folder(t.spark, "vector-index"), "hadm_id")


@query(
    "knn_pruned", with_ctes("near", f"SELECT query_id, neighbor_id, rank::INTEGER AS rank, {q_sql('distance')} AS distance FROM near")
)
def _(t: Tables):
    found = vi.search_exact(t.embeddings, _index(t), 5, "hadm_id")
    return found.withColumn("distance", q(F.col("distance")))


@query(
    "knn_index",
    with_ctes("near", "SELECT count(*) AS n_neighbors, TRUE AS recall_reached FROM near WHERE query_id % 50 = 0"),
)
def _(t: Tables):
    queries = t.embeddings.where("hadm_id % 50 = 0")
    exact = knn.nearest(queries, t.embeddings, 5, "hadm_id")
    found = vi.recall(vi.search(queries, _index(t), 5, "hadm_id"), exact)
    return found.select("n_neighbors", (F.col("recall") >= 0.9).alias("recall_reached"))


@query(
    "l2_distance",
    f"""SELECT a.vec_id AS id, {q_sql('list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) ** 2')} AS distance
        FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
)
def _(t: Tables):
    after = t.embeddings.select((F.col("hadm_id") - 1).alias("hadm_id"), F.col("embedding").alias("next"))
    both = t.embeddings.join(after, "hadm_id")
    return both.select(F.col("hadm_id").alias("id"), q(squared_l2(F.col("embedding"), F.col("next"))).alias("distance"))


@query(
    "case_lookup",
    "SELECT doc_id AS hadm_id, doc_id IN (SELECT vec_id FROM embeddings) AS found FROM documents",
)
def _(t: Tables):
    return knn.lookup(t.notes.select("hadm_id"), t.embeddings)


_LISTS = ("diagnoses", "medications", "procedures", "nlp_symptoms", "nlp_diseases", "nlp_medications")


@query(
    "case_labs",
    with_ctes(
        "lab_edge",
        """SELECT hadm_id, string_agg(itemid || '=' || floor(mean_value * 100 + 0.5003)::BIGINT, '|' ORDER BY itemid) AS lab_results
           FROM lab_edge GROUP BY hadm_id""",
    ),
)
def _(t: Tables):
    labs = cx.case_labs(graph(t).edges["HAS_LAB"])
    return labs.select("hadm_id", _labs_text().alias("lab_results"))


def _labs_text():
    def cell(x):
        return F.concat(x["item"].cast("string"), F.lit("="), F.floor(x["mean"] * 100 + 0.5003).cast("string"))

    return joined(F.transform("lab_results", cell))


@query(
    "case_subgraph",
    with_ctes(
        "profile",
        f"SELECT hadm_id, admission_type, insurance, {q_sql('los_hours')} AS los_hours, died, labs, "
        + ", ".join(f"array_to_string({c}, '|') AS {c}" for c in _LISTS)
        + " FROM profile",
    ),
)
def _(t: Tables):
    profile = cx.case_profiles(graph(t))
    return profile.select(
        "hadm_id", "admission_type", "insurance", q(F.col("los_hours")).alias("los_hours"), "died",
        _labs_text().alias("labs"), *[joined(F.col(c)).alias(c) for c in _LISTS],
    )


def _neighbours(t: Tables):
    return knn.nearest(t.embeddings, t.embeddings, 5, "hadm_id")


@query(
    "similar_cases",
    with_ctes(
        "near profile",
        """SELECT query_id, neighbor_id, rank::INTEGER AS rank, coalesce(died, -1) AS died, array_to_string(diagnoses, '|') AS diagnoses
           FROM near LEFT JOIN profile ON neighbor_id = hadm_id""",
    ),
)
def _(t: Tables):
    wanted = t.embeddings.select("hadm_id")
    found = cx.similar_cases(_neighbours(t), cx.case_profiles(graph(t), wanted))
    return found.select("query_id", "neighbor_id", "rank", F.coalesce("died", F.lit(-1)).alias("died"), joined(F.col("diagnoses")).alias("diagnoses"))


@query(
    "neighbor_outcome",
    with_ctes(
        "near adm",
        f"""SELECT query_id, count(*) AS n_neighbors, count(hospital_expire_flag) AS n_known,
            {q_sql('avg(hospital_expire_flag)')} AS death_rate FROM near LEFT JOIN adm ON neighbor_id = hadm_id GROUP BY query_id""",
    ),
)
def _(t: Tables):
    rates = knn.neighbour_outcome(_neighbours(t), t.admissions, flag="hospital_expire_flag")
    return rates.withColumn("death_rate", q(F.col("death_rate")))


def _list_sql(column: str) -> str:
    return f"coalesce(nullif(array_to_string({column}, ', '), ''), 'None')"


_CONTEXT_CTES = {
    "own": f"""SELECT e.vec_id AS hadm_id, concat_ws(chr(10), '{cx.QUERY_HEAD}',
        '{cx.QUERY_LINES[0]}' || CASE WHEN p.hadm_id IS NULL THEN 'N/A' ELSE coalesce(admission_type, 'None') END,
        '{cx.QUERY_LINES[1]}' || coalesce(printf('%.1f', los_hours) || ' hours', 'N/A'),
        '{cx.QUERY_LINES[2]}' || {_list_sql('diagnoses')}, '{cx.QUERY_LINES[3]}' || {_list_sql('medications')},
        '{cx.QUERY_LINES[4]}' || {_list_sql('procedures')}, '{cx.QUERY_LINES[5]}' || {_list_sql('nlp_symptoms')},
        '{cx.QUERY_LINES[6]}' || {_list_sql('nlp_diseases')}, '', '{cx.SIMILAR_HEAD}') AS head
        FROM embeddings e LEFT JOIN profile p ON e.vec_id = p.hadm_id""",
    "block": f"""SELECT query_id, rank, concat_ws(chr(10),
        chr(10) || '{cx.SIMILAR_TITLE[0]}' || rank || '{cx.SIMILAR_TITLE[1]}' || CASE WHEN died = 1 THEN 'DIED' ELSE 'SURVIVED' END,
        '{cx.SIMILAR_LINES[0]}' || {_list_sql('diagnoses')}, '{cx.SIMILAR_LINES[1]}' || {_list_sql('medications')},
        '{cx.SIMILAR_LINES[2]}' || {_list_sql('procedures')},
        '{cx.SIMILAR_LINES[3]}' || coalesce(printf('%.1f', los_hours), 'N/A')) AS txt
        FROM near LEFT JOIN profile ON neighbor_id = hadm_id""",
    "ctx": """SELECT hadm_id, head || chr(10) || string_agg(txt, chr(10) ORDER BY rank) AS context
        FROM own JOIN block ON hadm_id = query_id GROUP BY hadm_id, head""",
    "pred": """SELECT vec_id AS hadm_id, CASE WHEN p >= 0.5 THEN 'HIGH' ELSE 'LOW' END || ' MORTALITY RISK (confidence: '
        || printf('%.1f', p * 100) || '%)' AS prediction
        FROM (SELECT vec_id, (vec_id * 37 % 101) / 101.0::DOUBLE AS p FROM embeddings)""",
}


def _contexts(t: Tables):
    wanted = t.embeddings.select("hadm_id")
    return cx.case_context(wanted, _neighbours(t), cx.case_profiles(graph(t), wanted))


def _prompts(t: Tables):
    scores = t.embeddings.select("hadm_id", (F.col("hadm_id") * 37 % 101 / 101.0).alias("prob"))
    return cx.case_prompts(_contexts(t), scores)


@query("case_context", with_ctes("near profile", "SELECT hadm_id, context FROM ctx", **_CONTEXT_CTES))
def _(t: Tables):
    return _contexts(t).select("hadm_id", "context")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_BEFORE, _REST = cx.USER_PROMPT.split("{prediction}")
_MIDDLE, _AFTER = _REST.split("{context}")


@query(
    "case_prompt",
    with_ctes(
        "near profile",
        f"""SELECT ctx.hadm_id, {_quoted(cx.SYSTEM_PROMPT)} AS system_prompt,
            {_quoted(_BEFORE)} || prediction || {_quoted(_MIDDLE)} || context || {_quoted(_AFTER)} AS user_prompt
            FROM ctx JOIN pred ON ctx.hadm_id = pred.hadm_id""",
        **_CONTEXT_CTES,
    ),
)
def _(t: Tables):
    return _prompts(t).select("hadm_id", "system_prompt", "user_prompt")


@query(
    "case_result",
    with_ctes(
        "near profile",
        """SELECT pred.hadm_id, prediction, similar_patients FROM pred JOIN
           (SELECT query_id, string_agg(neighbor_id, '|' ORDER BY rank) AS similar_patients FROM near GROUP BY query_id)
           ON hadm_id = query_id""",
        **_CONTEXT_CTES,
    ),
)
def _(t: Tables):
    return cx.case_results(_prompts(t)).select("hadm_id", "prediction", joined(F.col("similar_patients")).alias("similar_patients"))
