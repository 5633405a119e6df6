import re
import zlib
from collections import Counter

import numpy as np

from casegraph.llm import toxicity as tx
from casegraph.llm.queries import QUERIES
from casegraph.llm.words import hash_runs


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = QUERIES["op6_toxicity"](spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    own = [(toxic[r.doc_id], r.predicted, r.score) for r in rows if r.held_out and r.doc_id in toxic]
    y, p, s = map(np.array, zip(*own))
    print("accuracy", (y == p).mean(), "precision", y[p == 1].mean(), "recall", p[y == 1].mean())
    assert (y == p).mean() > 0.985 and y[p == 1].mean() > 0.97 and p[y == 1].mean() > 0.88
    language = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    of = np.array([language[r.doc_id] for r in rows if r.held_out and r.doc_id in toxic])
    for lang in ("en", "de", "fr", "es"):
        recall = p[(y == 1) & (of == lang)].mean()
        print("recall", lang, recall)
        assert recall >= 0.75, lang


def plain_features(text):
    """Words of a text and the beginnings of longer ones, with their numbers."""
    raw = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode()
    words = re.findall(rb"[0-9a-z\x80-\xff]+", raw)
    return Counter(words + [w[:k] for w in words for k in tx.PREFIXES if len(w) > k])


def test_scores_match_brute_force(spark):
    texts = ["Boment bomentes BOMENTARIO, r\u00e9euxes!", "", None, "x" * 100_000, "boment " * 3000, "other words entirely", "Other other bomen"]
    model = {b"boment": 1.5, b"r\xc3\xa9eu": 0.7, b"other": -0.4, b"bomen": 0.25, b"absent": 9.0}
    hashes = [hash_of(w) for w in model]
    order = np.argsort(hashes)
    classifier = tx.Classifier(np.array(hashes, dtype=np.uint64)[order], np.array(list(model.values()))[order], -2.0)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in tx.score(docs, classifier).collect()}
    for i, text in enumerate(texts):
        counts = plain_features(text)
        total = -2.0 + sum(w * np.log2(1 + counts[f]) for f, w in model.items())
        want = 1 / (1 + np.exp(-total))
        assert abs(got[i].score - want) < 1e-12 and got[i].predicted == int(want >= 0.5)


def hash_of(word):
    data = np.frombuffer(word, dtype=np.uint8)
    return hash_runs(data, np.array([0]), np.array([len(data)]))[0]


def test_chosen_features_match_brute_force(spark):
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(["alpha", "beta", "gammadelta", "gammarays", "x"], 6, p=[0.3, 0.3, 0.02, 0.02, 0.36])) for _ in range(400)]
    texts[:60] = [t + (" vilenessa" if i % 2 else " vilenesse") for i, t in enumerate(texts[:60])]
    docs = spark.createDataFrame([(t, i < 60) for i, t in enumerate(texts)], "text string, _positive boolean")
    got = tx._chosen(docs, "text", tx.Settings())
    plain = [plain_features(t) for t in texts]
    want = []
    for f in set().union(*plain):
        p, u = sum(f in c for c in plain[:60]), sum(f in c for c in plain[60:])
        both = (p + u) / 400
        error = np.sqrt(both * (1 - both) * (1 / 60 + 1 / 340))
        if p + u >= 3 and abs(p / 60 - u / 340) > 4 * error:
            want.append(hash_of(f))
    assert want and got.tolist() == sorted(want)


def test_learning_from_copies_of_one_text_and_ties(spark):
    rows = [(i, "vile toad" if i % 3 == 0 else "mild bird") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)], "doc_id long, toxic int")
    got = tx.score(docs, tx.fit(docs, labels, ~tx.held_out())).collect()
    assert all(r.predicted == int(r.doc_id % 3 == 0) for r in got)
    assert len({r.score for r in got}) == 2


def test_odd_rows(spark):
    rows = [(i, "nice words here" if i % 4 else "you rotten fiend", "x") for i in range(200)]
    rows += [(500, None, "y"), (501, "", None), (None, "rotten fiend", ""), (3, "again nice", ""), (502, "rotten " * 50_000 + "fiend", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(0, 120)] + [(130, None), (None, 1)], "doc_id long, toxic int")
    model = tx.fit(docs, labels, ~tx.held_out())
    got = tx.score(docs, model).collect()
    assert len(got) == len(rows)
    assert all(r.predicted == int("rotten" in (r.text or "")) and 0 <= r.score <= 1 for r in got)
    assert tx.score(docs.limit(0), model).count() == 0
    empty = tx.fit(docs, labels.where("toxic = 0"), ~tx.held_out())
    assert {r.predicted for r in tx.score(docs, empty).collect()} == {0}
