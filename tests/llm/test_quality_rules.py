import duckdb
from pyspark.sql import functions as F

from casegraph.llm import quality_rules as qr
from casegraph.llm import queries as q
from oracle import connect, difference

SF = "/root/testdata/sf0.001"


def test_query_matches_sql(spark):
    result = q.QUERIES["op4_quality_rules"](spark, SF).toPandas()
    assert difference(result, connect(SF).execute(q.ORACLES["op4_quality_rules"]).df()) is None


GOOD = "plain honest words about many other things stand in this text number {}"
BAD = "buy now"


def planted(hosts):
    """Documents of hosts given as (host, good, bad)."""
    flags = [(host, text) for host, good, bad in hosts for text in [GOOD] * good + [BAD] * bad]
    return [(i, text.format(i), host) for i, (host, text) in enumerate(flags)]


def run_both(spark, tmp_path, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs.coalesce(2).write.parquet(str(tmp_path / "documents.parquet"))
    result = q.QUERIES["op4_quality_rules"](spark, str(tmp_path)).toPandas()
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert difference(result, db.execute(q.ORACLES["op4_quality_rules"]).df()) is None
    return result.set_index("doc_id").kept.to_dict()


def test_bad_host_is_rejected_and_tiny_or_null_hosts_are_shrunk(spark, tmp_path):
    hosts = [("spam", 8, 72), (None, 40, 2)] + [(f"site{i}", 45, 5) for i in range(8)] + [(f"tiny{i}", 2, 0) for i in range(12)]
    rows = planted(hosts + [("unlucky", 1, 1)])
    kept = run_both(spark, tmp_path, rows)
    for i, text, host in rows:
        assert kept[i] == (text != BAD and host != "spam"), (i, host)


def test_null_host_can_be_rejected(spark, tmp_path):
    rows = planted([(None, 6, 60)] + [(f"site{i}", 45, 5) for i in range(8)])
    kept = run_both(spark, tmp_path, rows)
    assert all(kept[i] == (text != BAD and host is not None) for i, text, host in rows)


def test_small_hosts_that_differ_by_chance_get_the_largest_weight(spark):
    # 400 hosts of two documents, one document in six fails whatever its host
    failed = [(i * 7919) % 6 == 0 for i in range(800)]
    rows = [(f"h{i // 2}", bad) for i, bad in enumerate(failed)] + [("both", True)] * 2
    verdicts = qr.host_verdicts(spark.createDataFrame(rows, "source string, failed boolean"), "source").collect()
    assert not any(r.host_rejected for r in verdicts)


def test_prior_matches_a_plain_computation(spark):
    counts = [(50, 5), (40, 30), (3, 0), (2, 2), (100, 12), (1, 1), (7, 0)]
    rows = [(str(i), j < x) for i, (n, x) in enumerate(counts) for j in range(n)]
    verdicts = {r.host: r for r in qr.host_verdicts(spark.createDataFrame(rows, "source string, failed boolean"), "source").collect()}
    total, k = sum(n for n, _ in counts), len(counts)
    m = sum(x for _, x in counts) / total
    spread = sum(n * (x / n - m) ** 2 for n, x in counts)
    rho = (spread / (m * (1 - m)) - (k - 1)) / (total - sum(n * n for n, _ in counts) / total - (k - 1))
    weight = min(1000.0, max(2.0, 1 / rho - 1))
    for i, (n, x) in enumerate(counts):
        assert abs(verdicts[str(i)].host_rate - (x + m * weight) / (n + weight)) < 1e-9


def test_odd_rows(spark, tmp_path):
    rows = [(1, None, "a"), (2, "", "a"), (3, "word " * 60_000, "a"), (4, GOOD, "b"), (4, GOOD, "b"), (None, GOOD, None), (5, " \n\t ", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs = docs.withColumns({"kept": F.lit("own"), "N_Words": F.lit(-1), "_host": F.lit("h"), "_bad": F.lit(0), "failed": F.lit("f")})
    got = qr.keep_documents(docs, limits=qr.Limits(max_host_rate=1.0))
    assert got.columns == docs.columns
    assert sorted((r.doc_id or 0, r.kept, r["N_Words"], r["_host"], r["_bad"], r.failed) for r in got.collect()) == [
        (i, "own", -1, "h", 0, "f") for i in (0, 4, 4)
    ]
    assert qr.keep_documents(docs.limit(0)).count() == 0
    counts = {r.doc_id: (r.n_words, r.n_repeat_words) for r in qr.with_rules(docs.where("doc_id < 4"), keep=["doc_id"]).collect()}
    assert counts == {1: (0, 0), 2: (0, 0), 3: (60_000, 60_000)}
