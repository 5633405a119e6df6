import hashlib
import re
import string

import numpy as np
import pytest

from casegraph.llm.decontaminate import mark_contamination, remove_spans
from casegraph.llm.fm_index import FMIndex
from casegraph.llm.queries import QUERIES

LOWER = {ord(c): c.lower() for c in string.ascii_uppercase}
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def brute(docs, items):
    """(n_words, hit words, item ids) per text."""
    phrases = {}
    for id, text in items:
        words = tuple(re.findall(WORD, (text or "").translate(LOWER)))
        for i in range(max(1, len(words) - 9)) if words else ():
            phrases.setdefault(words[i : i + 10], set()).add(id)
    out = []
    for text in docs:
        words = tuple(re.findall(WORD, (text or "").translate(LOWER)))
        hit, found = set(), set()
        for n in {len(p) for p in phrases}:
            for i in range(len(words) - n + 1):
                if words[i : i + n] in phrases:
                    found |= phrases[words[i : i + n]]
                    hit |= set(range(i, i + n))
        out.append((len(words), hit, found))
    return out


@pytest.mark.parametrize("size,n,length", [(3, 400, 3), (20, 3000, 2), (1, 50, 4), (5, 2000, 1)])
def test_index_finds_all_occurrences(size, n, length):
    rng = np.random.default_rng(size)
    symbols = rng.integers(0, size + 1, n)
    symbols[0] = symbols[-1] = 0
    index = FMIndex(symbols, size)
    patterns = rng.integers(1, size + 1, (50, length))
    for pattern, a, b in zip(patterns, *index.search(patterns)):
        want = [i for i in range(n - length + 1) if (symbols[i : i + length] == pattern).all()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == want


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_matches_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = {}
    for d, (n, hit, found) in zip(docs, brute([d.text for d in docs], items)):
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        want[d.doc_id] = (n, len(hit), len(found), digest, bool(hit))
    rows = QUERIES["op7_decontamination"](spark, sf).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows} == want
    assert any(r.contaminated for r in rows)


def test_odd_rows(spark):
    long_item = " ".join(f"w{i}" for i in range(14))
    items = [(1, long_item), (2, "été Court"), (3, None), (4, "..."), (None, "nobody knows"), (1, "second row of one"), (5, long_item)]
    texts = ["", None, "été COURT!", "x " + long_item.replace(" ", ",  ") + " y", "w1 w2 w3", "- nobody - knows - été court",
             "second row of one w0", "a " * 50_000 + long_item + " b" * 50_000, "w0 " * 30 + long_item, "été", "court nobody"]
    docs = spark.createDataFrame([(t, 7, i) for i, t in enumerate(texts)], "text string, n_hit int, doc_id long")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block in (16 << 20, 40):
        rows = mark_contamination(docs, bench, block_bytes=block).collect()
        got = {r.doc_id: (r.n_words, r.n_hit, set(r.items)) for r in rows}
        assert got == {i: (n, len(hit), found) for i, (n, hit, found) in enumerate(brute(texts, items))}
    cut = {r.doc_id: r.text for r in remove_spans(docs, bench).collect()}
    assert cut[3] == "x  y" and cut[2] == "!" and cut[5] == "- " and cut[1] is None and cut[4] == texts[4]
    assert mark_contamination(docs.limit(0), bench).count() == 0
    assert {r.n_hit for r in mark_contamination(docs, bench.limit(0)).collect()} == {0}
