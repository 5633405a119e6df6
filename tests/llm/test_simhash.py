import re
import string

import numpy as np
import xxhash

from casegraph.llm import simhash as sh
from casegraph.llm.queries import QUERIES

LOWER = {ord(c): c.lower() for c in string.ascii_uppercase}


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, values, budget=3):
    v = np.array(values, dtype=np.uint64)
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(v ^ v[i]) <= budget):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    groups = {}
    for i in range(len(ids)):
        groups.setdefault(find(i), []).append(ids[i])
    return {i: min(g) for g in groups.values() for i in g}


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    ids, values = [d.doc_id for d in docs], [brute_fingerprint(d.text) for d in docs]
    expected = {i: (f"{v:016x}", c) for (i, c), v in zip(sorted(brute_components(ids, values).items()), [v for _, v in sorted(zip(ids, values))])}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op1_simhash"](spark, sf).collect()} == expected


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "y"), (3, "One two", None), (4, "one\ttwo", ""), (5, "ONE two", "z"), (None, "one two", "z"),
            (7, "é " * 5000, ""), (7, "é " * 5000, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in sh.near_duplicates(docs).collect())
    want = {i: brute_fingerprint(t) for i, t, _ in rows}
    assert all(f == f"{want[int(i) if i != 'None' else None]:016x}" for i, f, _ in got)
    assert [c for _, _, c in got] == [1, 1, 3, 3, 3, 7, 7, 3]
    assert sorted(str(r.doc_id) for r in sh.keep_first(docs).collect()) == ["1", "3", "7", "7", "None"]
    assert sh.near_duplicates(docs.limit(0)).count() == 0


def test_trie_join_splits_nodes(spark):
    rng = np.random.default_rng(5)
    seeds = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (40, 30, 2)).astype(np.uint64)
    dense = np.uint64(0xFFFF000000000000) + np.arange(300, dtype=np.uint64)  # many fingerprints below one node
    values = np.unique(np.concatenate([(seeds[:, None] ^ flips[..., 0] ^ flips[..., 1]).ravel(), dense]))
    ids = values.view(np.int64).tolist()
    expected = brute_components(ids, values)
    frame = spark.createDataFrame([(i,) for i in ids], "fingerprint_bits long")
    for size in (100, 10_000):
        links = sh.link_fingerprints(frame, node_size=size)
        got = {r.node: r.root for r in sh.components(links).collect()}
        assert {i: got.get(i, i) for i in ids} == expected


def test_fingerprints_beyond_the_bound_are_not_broadcast(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"the same {i % 5} words stand here") for i in range(30)], "doc_id long, text string")
    few = sh.near_duplicates(docs)
    monkeypatch.setattr("casegraph.llm.components.MAX_BROADCAST", 0)
    many = sh.near_duplicates(docs, max_broadcast=0)
    assert "Broadcast" in (plan := lambda df: df._jdf.queryExecution().executedPlan().toString())(few) and "Broadcast" not in plan(many)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect()))
    kept = sh.keep_first(docs, max_broadcast=0)
    assert "Broadcast" not in plan(kept) and kept.count() == sh.keep_first(docs).count()
