import zlib
from collections import Counter

from casegraph.llm import sharding as sd
from casegraph.llm.queries import QUERIES

SMALL = sd.Settings(shards=5, bucket_bytes=2000)


def check_shards(rows, n, shards):
    """Counts at most one apart, slots without gaps."""
    sizes = Counter(r.shard for r in rows)
    assert set(sizes) <= set(range(shards)) and len(rows) == n
    counts = [sizes[s] for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    rows = QUERIES["op12_sharding"](spark, sf).collect()
    check_shards(rows, len(docs), 16)
    want = Counter((d.doc_id, len((d.text or "").encode()) + 1, zlib.crc32((d.text or "").encode())) for d in docs)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == want
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, shard string, place int, extra map<string,int>").repartition(3)


def test_ties_nulls_long_texts_and_clashing_columns(spark):
    rows = [(i, f"text {i}", "own", i, {"a": i}) for i in range(103)]
    rows += [(7, "again", "own", 7, None)] * 60 + [(None, None, None, None, None)] * 3 + [(500, "x" * 50_000, "own", 0, None), (501, "", "own", 0, None)]
    got = sd.shard_documents(frame(spark, rows), settings=SMALL)
    assert got.columns == ["doc_id", "text", "own_shard", "own_place", "extra", "slot", "shard"]
    found = got.collect()
    check_shards(found, len(rows), 5)
    key = Counter((r.doc_id, r.text, r.own_shard, r.own_place, str(r.extra)) for r in found)
    assert key == Counter((a, b, c, d, str(e)) for a, b, c, d, e in rows)


def test_fewer_records_than_shards_and_none(spark):
    rows = [(i, "t", None, 0, None) for i in range(3)]
    check_shards(sd.shard_documents(frame(spark, rows), settings=SMALL).collect(), 3, 5)
    assert sd.shard_documents(frame(spark, []), settings=SMALL).count() == 0


def order(spark, docs, settings):
    return [r.doc_id for r in sd.shard_documents(docs, settings=settings).orderBy("shard", "slot").collect()]


def test_order_is_random_and_repeatable(spark, tmp_path):
    path = str(tmp_path / "docs")
    spark.range(4000).selectExpr("id AS doc_id", "repeat('x', 20) AS text").repartition(4).write.parquet(path)
    docs = spark.read.parquet(path)
    settings = sd.Settings(shards=4, bucket_bytes=40_000)
    assert sd.bucket_count(docs, "text", settings) > 5
    first = order(spark, docs, settings)
    assert first == order(spark, docs, settings)
    assert first != order(spark, docs, sd.Settings(shards=4, bucket_bytes=40_000, seed=43))
    # a uniform order: every quarter of the ids is spread over all shards, and few neighbours stay neighbours
    cells = Counter((place * 4 // 4000, i * 4 // 4000) for place, i in enumerate(first))
    assert len(cells) == 16 and all(190 < n < 310 for n in cells.values())
    assert sum(abs(a - b) == 1 for a, b in zip(first, first[1:])) < 20


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = sd.shuffled_buckets(docs, "doc_id", 4, 1)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Python" not in plan and "Arrow" not in plan
