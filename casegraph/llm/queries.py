"""The operators as queries over the test tables, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


OP4_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
line_counts AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM d WHERE len(words) >= 5)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS c FROM windows) WHERE c > 1),
repeats AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM again, range(5) AS r(k) GROUP BY doc_id),
counts AS (
  SELECT doc_id, source, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d LEFT JOIN line_counts USING (doc_id) LEFT JOIN repeats USING (doc_id)),
base AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts),
own AS (
  SELECT *, base_failed OR 100 * n_symbols > 10 * n_words OR word_chars < 3 * n_words OR word_chars > 10 * n_words AS doc_failed
  FROM base),
failures AS (SELECT *, doc_failed OR 100 * n_dup_lines > 30 * n_lines AS failed FROM own),
hosts AS (SELECT source, count(*) AS n, count(*) FILTER (failed) AS f FROM failures GROUP BY source),
sums AS (SELECT count(*) AS k, sum(n)::DOUBLE AS d, sum(f)::DOUBLE AS x, sum(n::DOUBLE * n) AS q, sum(f::DOUBLE * f / n) AS r FROM hosts),
moments AS (SELECT x / d AS m, (r - x * x / d) / nullif(x / d * (1 - x / d), 0) - (k - 1) AS extra, d - q / d - (k - 1) AS room FROM sums),
prior AS (
  SELECT m, CASE WHEN room > 0 AND extra > 0 THEN least(1000.0, greatest(2.0, room / extra - 1)) ELSE 1000.0 END AS w FROM moments),
bad AS (SELECT source FROM hosts, prior WHERE (f + m * w) / (n + w) > 0.5)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT doc_failed AND NOT EXISTS (SELECT 1 FROM bad WHERE bad.source IS NOT DISTINCT FROM failures.source) AS kept
FROM failures
"""


@query("op4_quality_rules", OP4_SQL)
def quality_rules_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from casegraph.llm import quality_rules as qr
    from casegraph.session import materialize

    ruled = materialize(qr.with_rules(table(spark, sf_dir, "documents"), keep=["doc_id", "source"]), "quality-rules")
    joined = qr.join_verdicts(ruled, qr.host_verdicts(ruled, "source"), "source")
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op1_simhash")
def simhash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from casegraph.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op2_packing")
def packing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from casegraph.llm.packing import pack

    pieces = pack(table(spark, sf_dir, "documents"))
    digest = F.crc32("ids").alias("ids_crc32")
    return pieces.select("doc_id", "start", "length", digest, "doc_tokens", "sequence_id", "offset")


@query("op8_token_files")
def token_files_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from casegraph.llm import token_files as tf

    docs = table(spark, sf_dir, "documents")
    folder = tf.new_folder(docs)
    read = tf.read_files(tf.write_files(docs, folder), folder)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op7_decontamination")
def decontamination_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from casegraph.llm.decontaminate import mark_contamination

    marked = mark_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    listed = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return marked.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op5_language_model")
def language_model_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from casegraph.llm import language_model as lm

    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", ~lm.training())
    model = lm.train(docs.where(lm.training()))
    return lm.score(docs, model).drop("text", "perplexity")


@query("op6_toxicity")
def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from casegraph.llm import toxicity as tx

    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", tx.held_out())
    classifier = tx.fit(docs, table(spark, sf_dir, "labels"), ~tx.held_out())
    return tx.score(docs, classifier, keep=["doc_id", "held_out"])


@query("op10_quality_classifier")
def quality_classifier_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from casegraph.llm import quality_classifier as qc

    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", qc.held_out())
    machine = qc.fit(docs, table(spark, sf_dir, "labels"), ~qc.held_out())
    return qc.score(docs, machine, keep=["doc_id", "held_out"])


@query("op9_line_dedup")
def line_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from casegraph.llm.line_dedup import dedup_lines

    cleaned = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_lines", "n_removed", F.md5("text").alias("text_md5"))


@query("op3_html_text")
def html_text_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from casegraph.llm.html_text import extract

    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


def _op11_sql() -> str:
    """The ten rounds one after another; a row per vector and centroid in each."""
    distance = "list_sum(list_transform(list_zip(v.q, c.q), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    floor_div = "(s - ((s % n) + n) % n) // n"
    parts = [
        """kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id,
             list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS q FROM embeddings
             WHERE len(embedding) = 64 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))))""",
        """c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), q) - 1 AS cluster, q
             FROM kept ORDER BY sha256('3:' || vec_id), q LIMIT 8)""",
    ]
    for i in range(11):
        parts.append(
            f"""a{i} AS MATERIALIZED (SELECT r, min(struct_pack(d := d, c := cluster)) AS best FROM
                  (SELECT v.r, c.cluster, {distance}::BIGINT AS d FROM kept v, c{i} c) GROUP BY r)"""
        )
        if i < 10:
            parts.append(
                f"""c{i + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.q, c.q) AS q FROM c{i} c LEFT JOIN
                      (SELECT cluster, list({floor_div} ORDER BY p) AS q FROM
                        (SELECT cluster, p, sum(x)::BIGINT AS s, count(*) AS n FROM
                          (SELECT best.c AS cluster, unnest(q) AS x, generate_subscripts(q, 1) AS p FROM a{i} JOIN kept USING (r))
                         GROUP BY cluster, p) GROUP BY cluster) m USING (cluster))"""
            )
    return (
        "WITH "
        + ", ".join(parts)
        + """ SELECT vec_id, best.c::INTEGER AS cluster, best.d AS distance,
            (sum(best.d) OVER (PARTITION BY best.c))::BIGINT AS cluster_inertia, (sum(best.d) OVER ())::BIGINT AS inertia,
            sha256(array_to_string(c10.q, ',')) AS centroid_sha256
            FROM a10 JOIN kept USING (r) JOIN c10 ON best.c = c10.cluster"""
    )


@query("op11_centroids", _op11_sql())
def centroids_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from casegraph.llm import centroids as ce

    members = ce.with_inertia(ce.cluster_vectors(table(spark, sf_dir, "embeddings")))
    return members.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


@query("op12_sharding")
def sharding_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from casegraph.llm import sharding as sd

    shards = sd.shard_documents(table(spark, sf_dir, "documents"))
    return shards.select(
        "doc_id",
        sd.text_size("text").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit(sd.LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op13_resampling")
def resampling_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from casegraph.llm.resampling import resample

    docs, target = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return resample(docs, target, keep=["doc_id"]).select("doc_id", "n_features", "weight", "score", "rank")
