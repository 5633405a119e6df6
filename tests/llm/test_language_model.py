import math
import re
import string
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from casegraph.llm import language_model as lm
from casegraph.llm.queries import QUERIES
from casegraph.llm.words import mix

LOWER = {ord(c): c.lower() for c in string.ascii_uppercase}


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)) + ["</s>"]


def discounts(counts):
    n = [sum(c == k for c in counts) for k in range(1, 5)]
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0
    return [0.0] + [min(max((k - (k + 1) * y * n[k] / n[k - 1]) if n[k - 1] else 0, 0), k) for k in (1, 2, 3)]


def brute(train, texts):
    """(n_tokens, n_known, all tokens, base, score) of each text."""
    words, pairs = Counter(), Counter()
    for t in train:
        own = tokens(t)
        words.update(own)
        pairs.update(zip(["<s>"] + own, own))
    total, v = sum(words.values()), len(words)
    before, context = Counter(), defaultdict(list)
    for (a, b), c in pairs.items():
        before[b] += 1
        context[a].append(c)
    d2, d1 = discounts(pairs.values()), discounts(before.values())
    backoff1 = sum(d1[min(c, 3)] for c in before.values()) / len(pairs) if pairs else 1.0

    def p(a, b):
        c = before[b]
        low = (max(c - d1[min(c, 3)], 0) / len(pairs) if pairs else 0) + backoff1 / (v + 1)
        if a not in context:
            return low
        n, own = sum(context[a]), pairs[a, b]
        return max(own - d2[min(own, 3)], 0) / n + sum(d2[min(c, 3)] for c in context[a]) / n * low

    out = []
    for t in texts:
        own = tokens(t)
        base = sum(math.log10((words[w] + 1) / (total + v + 1)) for w in own)
        out.append((len(own), sum(words[w] > 0 for w in own), total, base, sum(math.log10(p(a, b)) for a, b in zip(["<s>"] + own, own))))
    return out


def check(rows, want):
    for r in rows:
        n, known, total, base, score = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-5)


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    held = {d.doc_id: zlib.crc32(str(d.doc_id).encode()) % 7 == 2 for d in docs}
    want = brute([d.text for d in docs if not held[d.doc_id]], [d.text for d in docs])
    rows = QUERIES["op5_language_model"](spark, sf).collect()
    assert {r.doc_id: r.held_out for r in rows} == held
    check(rows, {d.doc_id: w for d, w in zip(docs, want)})
    own = [r for r in rows if r.held_out]
    assert sum(r.score for r in own) > sum(r.base_score for r in own)


def test_many_ranges_and_odd_rows(spark, monkeypatch):
    texts = ["a b a b c", None, "", "A b\tc", "the the the the", "é x", "a b a b c", "long " * 40_000, "x y z q"] * 2
    monkeypatch.setattr(lm, "SHARD_BYTES", 100_000)
    docs = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)], "doc_id long, text string, score int").repartition(3)
    model = lm.train(docs.where("doc_id < 9"))
    assert len(model.words.files) > 1
    check(lm.score(docs, model).collect(), dict(enumerate(brute(texts[:9], texts))))
    nothing = lm.train(docs.limit(0))
    check(lm.score(docs, nothing).collect(), dict(enumerate(brute([], texts))))
    assert lm.score(docs.limit(0), model).count() == 0


def test_hash_of_pairs_can_be_undone():
    keys = np.random.default_rng(0).integers(0, 1 << 63, 1000, dtype=np.uint64) * np.uint64(2)
    assert (lm._unmix(mix(keys)) == keys).all()
