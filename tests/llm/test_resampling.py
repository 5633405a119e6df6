import hashlib
import math
import re
import string
import zlib

import numpy as np
import pyarrow as pa

from casegraph.llm import resampling as rs
from casegraph.llm.queries import QUERIES
from casegraph.llm.words import slices

LOWER = {ord(c): c.lower() for c in string.ascii_uppercase}
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def grams(text):
    words = re.findall(WORD, (text or "").translate(LOWER))
    return words, [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def brute(docs, target):
    """(id, n_features, weight, score, rank) by the definition."""

    def count(texts):
        out = [0] * 10000
        for text in texts:
            for g in grams(text)[1]:
                out[zlib.crc32(g.encode()) % 10000] += 1
        return out

    s, t = count([x for _, x in docs]), count(target)
    big_s, big_t = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((b + 1) * (big_s + 10000) / ((a + 1) * (big_t + 10000)))) for a, b in zip(s, t)]
    rows = []
    for i, text in docs:
        words, found = grams(text)
        weight = sum(gain[zlib.crc32(g.encode()) % 10000] for g in found)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((len(words), i, len(found), weight, score))
    long = sorted((r for r in rows if r[0] >= 20), key=lambda r: (-r[4], r[1] is not None, r[1] or 0))
    drawn = 5 * len(long) // 100
    ranks = {}
    for place, r in enumerate(long[:drawn], 1):
        ranks.setdefault(r, []).append(place)
    return sorted(((*r[1:], ranks[r].pop(0) if ranks.get(r) else None) for r in rows), key=str)


def collected(df):
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert collected(QUERIES["op13_resampling"](spark, sf)) == brute(docs, target)


def test_checksums_of_runs():
    rng = np.random.default_rng(3)
    words = [bytes(rng.integers(97, 123, n).astype(np.uint8)).decode() for n in [1, 2, 5, 63, 64, 65, 66, 200, 5000, 3, 1]]
    texts = [" ".join(words), "", None, "É  x\ny", "\n\n", "a-B_c", words[8], "x " * 400_000]
    found = [[], [], []]
    for piece in slices(pa.array(texts)):
        for n, (bucket, of, _) in enumerate(rs.features(piece, 3, 1 << 32)):
            found[n] += [(piece.first + t, b) for t, b in zip(of.tolist(), bucket.tolist())]
    for n in (1, 2, 3):
        want = []
        for row, text in enumerate(texts):
            w = grams(text)[0]
            want += [(row, zlib.crc32(" ".join(w[i : i + n]).encode())) for i in range(len(w) - n + 1)]
        assert found[n - 1] == want


def test_lines_and_crossing_runs_add_up(spark):
    texts = ["one two\nthree\n\nfour five six", "one two\nthree", "one two", "", None, "seven\neight\nnine\nten", "one two\n"] * 3
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    want = np.zeros(10000, dtype=np.int64)
    for t in texts:
        for g in grams(t)[1]:
            want[zlib.crc32(g.encode()) % 10000] += 1
    assert np.array_equal(rs.bucket_counts(df, "text", rs.Settings()), want)
    lines = rs.line_counts(df, rs.Settings()).groupBy().sum("n").first()[0]
    crossing = rs.crossing_counts(df, rs.Settings()).groupBy().sum("n").first()[0]
    assert lines + crossing == want.sum() and crossing > 0


def rows_of(n):
    return [(i, " ".join(f"w{(i * k) % 17}" for k in range(15 + i % 30))) for i in range(n)]


def test_ties_repeated_rows_nulls_and_other_columns(spark):
    docs = rows_of(80) + [(5, "w1 " * 25)] * 40 + [(None, "w2 " * 30)] * 2 + [(None, None), (200, ""), (201, "x" * 100_000 + " y")]
    target = ["w1 w2 w3", None, ""]
    df = spark.createDataFrame([(*d, "own", 7) for d in docs], "doc_id long, text string, place string, id int").repartition(4)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    got = rs.resample(df, wanted)
    assert got.columns == ["doc_id", "text", "place", "id", "n_words", "n_features", "weight", "score", "rank"]
    assert collected(got) == brute(docs, target)
    assert {(r.place, r.id) for r in got.collect()} == {("own", 7)}
    n = sum(len(grams(t)[0]) >= 20 for _, t in docs)
    assert sorted(r["rank"] for r in rs.draw(df, wanted).collect()) == list(range(1, 5 * n // 100 + 1))


def test_clashing_results_and_empty_tables(spark):
    docs = spark.createDataFrame([(i, t, 1, 1.0) for i, t in rows_of(30)], "doc_id long, text string, rank int, score double")
    nothing = docs.limit(0)
    assert collected(rs.resample(docs, nothing)) == brute(rows_of(30), [])
    assert rs.resample(nothing, docs).count() == 0 and rs.draw(nothing, nothing).count() == 0
