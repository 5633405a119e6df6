import random
import sys
from collections import Counter

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from casegraph.functions import text as tx
from casegraph.functions.scalars import fixed1, percent1, risk_label
from casegraph.operators import entities as en

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def one(spark, value, build, dtype="string"):
    return spark.createDataFrame([(value,)], f"x {dtype}").select(build(F.col("x"))).first()[0]


@pytest.mark.parametrize("text", ["a b\tc  d", "  lead", "", "one", "x\ny\r\nz"])
def test_words_split_like_python(spark, text):
    assert one(spark, text, tx.words) == text.split()


@pytest.mark.parametrize("n", [349, 350, 351])
def test_first_words(spark, n):
    text = " ".join(f"w{i}" for i in range(n))
    assert one(spark, text, tx.first_words) == " ".join(text.split()[:350])


def test_blank(spark):
    got = [one(spark, v, tx.is_blank) for v in ("", "  \t", "a", None)]
    assert got == [True, True, False, True]


def test_clean_mentions(spark):
    got = one(spark, ["##ing", "ab", "well", " Fever ", "fever", "HIGH", "abc"], tx.clean_mentions, "array<string>")
    assert got == ["fever", "fever", "abc"]
    assert one(spark, [], tx.clean_mentions, "array<string>") == []


def test_list_or_none(spark):
    assert [one(spark, v, tx.list_or_none, "array<string>") for v in ([], None, ["a"], ["a", "b"])] == [
        "None", "None", "a", "a, b",
    ]


def test_one_decimal_as_python_prints_it(spark):
    values = [12.25, 0.35, 0.45, 0.0, -0.04, -2.25, 1e6 + 0.05, 33.333, 2.675, 0.25, 0.75, 1.15, 8.85, 1234567.85]
    values += [i / 40 for i in range(-400, 4000)] + [i / 3600 for i in range(0, 90000, 37)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(fixed1(F.col("x"))).collect()]
    assert got == [f"{v:.1f}" for v in values]
    got = [r[0] for r in df.select(percent1(F.col("x"))).collect()]
    assert got == [f"{v:.1%}" for v in values]
    assert one(spark, None, fixed1, "double") is None


def test_risk_label(spark):
    assert one(spark, 0.5, risk_label, "double") == "HIGH MORTALITY RISK (confidence: 50.0%)"
    assert one(spark, 0.0625, risk_label, "double") == "LOW MORTALITY RISK (confidence: 6.2%)"


@pytest.mark.parametrize(
    "labels, expected",
    [(["O", "B-Medication", "Medication"], "Medication"), (["B-Drug", "B-Chemical"], "Chemical"), (["O"], None), ([], None)],
)
def test_resolve_label(spark, labels, expected):
    df = spark.createDataFrame([(v,) for v in labels], "label string")
    assert en.resolve_label(df, "label").first()[0] == expected


def test_dictionary_mentions(spark):
    notes = spark.createDataFrame(
        [(1, "Chest pain, chest-pain! pain"), (1, "chest"), (2, ""), (3, "pain in the left arm"), (4, None)],
        "hadm_id bigint, text string",
    )
    dictionary = spark.createDataFrame(
        [("Chest pain", "symptom"), ("pain", "symptom"), ("left arm", "disease"), ("in the left", "medication"), (" ", "disease")],
        "term string, kind string",
    )
    got = sorted(tuple(r) for r in en.dictionary_mentions(notes, dictionary).collect())
    assert got == [
        (1, "chest pain", "symptom", 2), (1, "pain", "symptom", 3), (3, "in the left", "medication", 1),
        (3, "left arm", "disease", 1), (3, "pain", "symptom", 1),
    ]


def test_dictionary_too_large_to_broadcast(spark, monkeypatch):
    notes = spark.createDataFrame([(1, "a b a"), (2, "b")], "hadm_id bigint, text string")
    dictionary = spark.createDataFrame([("a", "symptom"), ("b a", "disease")], "term string, kind string")
    before = sorted(map(tuple, en.dictionary_mentions(notes, dictionary).collect()))
    monkeypatch.setattr(en, "MAX_BROADCAST_TERMS", 0)
    assert sorted(map(tuple, en.dictionary_mentions(notes, dictionary).collect())) == before


def load_model():
    def model(texts):
        if any("bad" in t for t in texts):
            raise ValueError("cannot read")
        groups = {"cough": "Sign_symptom", "flu": "Disease_disorder", "aspirin": "Drug", "noise": "Other"}
        return [[{"entity_group": groups[w], "word": w.title() + " "} for w in t.split() if w in groups] for t in texts]

    return model


def test_model_failure_stays_with_its_note(spark):
    notes = spark.createDataFrame(
        [(1, "cough and flu"), (2, "bad"), (1, "cough aspirin noise"), (3, "nothing"), (4, "  ")], "hadm_id bigint, text string"
    ).coalesce(1)
    extracted = en.model_mentions(notes, load_model)
    errors = {r["hadm_id"]: r["error"] for r in extracted.collect()}
    assert errors == {1: None, 2: "ValueError: cannot read", 3: None, 4: None}
    sets = en.entity_sets(en.mention_rows(extracted, en.label_kinds("Drug")))
    full = {r["hadm_id"]: tuple(r)[1:] for r in en.complete_entity_sets(sets, extracted.where("error IS NULL")).collect()}
    assert full == {1: (["cough"], ["flu"], ["aspirin"]), 3: ([], [], []), 4: ([], [], [])}
    done = spark.createDataFrame([(9,)], "hadm_id bigint")
    report = {r["metric"]: r["value"] for r in en.extraction_report(extracted, notes, done).collect()}
    assert report == {"processed": 5, "failed": 1, "enriched": 3, "skipped": 0}


def test_window_is_optional(spark):
    notes = spark.createDataFrame([(1, "x " * 400 + "cough")], "hadm_id bigint, text string")
    whole = en.model_mentions(notes, load_model).first()["mentions"]
    assert len(whole) == 1
    assert en.model_mentions(notes, load_model, window_words=350).first()["mentions"] == []


def test_merge_is_idempotent(spark):
    schema = "hadm_id bigint, symptoms array<string>, diseases array<string>, medications array<string>"
    a = spark.createDataFrame([(1, ["x"], [], ["m"]), (2, [], [], [])], schema)
    b = spark.createDataFrame([(1, ["y", "x"], ["d"], []), (3, ["z"], [], [])], schema)
    merged = en.merge_entity_sets(a, b)
    again = en.merge_entity_sets(merged, b)
    expected = [(1, ["x", "y"], ["d"], ["m"]), (2, [], [], []), (3, ["z"], [], [])]
    assert sorted(map(tuple, merged.collect())) == expected == sorted(map(tuple, again.collect()))


def test_counts_of_cleaned_and_raw_lists(spark):
    schema = "hadm_id bigint, symptoms array<string>, diseases array<string>, medications array<string>"
    sets = spark.createDataFrame([(1, ["fever", "##er", "ab"], [], ["well"])], schema)
    assert tuple(en.entity_counts(sets).first()) == (1, 1, 0, 0)
    assert tuple(en.entity_counts(sets, cleaned=False).first()) == (1, 3, 0, 1)


def test_long_terms_and_many_terms_with_one_first_word(spark):
    terms = [("acute on chronic renal failure", "disease"), ("renal failure", "disease"), ("a b c d e f g h", "symptom")]
    terms += [(f"acute x{i}", "symptom") for i in range(5000)]
    dictionary = spark.createDataFrame(terms, "term string, kind string")
    text = "Acute on chronic renal failure; acute x17 and a b c d e f g h, acute x4999 acute x17"
    notes = spark.createDataFrame([(1, text), (2, ""), (3, "renal")], "hadm_id bigint, text string")
    got = {(r["term"], r["n"]) for r in en.dictionary_mentions(notes, dictionary).collect()}
    assert got == {
        ("acute on chronic renal failure", 1), ("renal failure", 1), ("a b c d e f g h", 1), ("acute x17", 2), ("acute x4999", 1)
    }
    assert en.dictionary_mentions(notes, dictionary.limit(0)).count() == 0


def test_automaton_finds_long_and_overlapping_terms(spark):
    rng = random.Random(5)
    letters = [f"w{i}" for i in range(6)]
    terms = {tuple(rng.choice(letters) for _ in range(rng.randrange(1, 6))) for _ in range(60)}
    terms |= {tuple(rng.choice(letters[:2]) for _ in range(n)) for n in (40, 41, 300)} | {("w0",) * n for n in range(1, 8)}
    texts = [" ".join(rng.choice([*letters, "other"]) for _ in range(rng.randrange(0, 200))) for _ in range(40)]
    texts += ["other ".join(" ".join(t) + " " for t in terms), "w0 " * 3000, "", None, "w0"]
    kinds = {t: ["symptom", "disease"][: 1 + i % 2] for i, t in enumerate(sorted(terms))}
    rows = [(" ".join(t), kind) for t in kinds for kind in kinds[t]]
    notes = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(3, "w0 w1"), (None, "w0")], "hadm_id long, text string")
    dictionary = spark.createDataFrame(rows + rows[:5] + [("...", "symptom")], "term string, kind string")
    want = Counter()
    for r in notes.collect():
        words = (r.text or "").split()
        for t in terms:
            n = sum(tuple(words[i : i + len(t)]) == t for i in range(len(words) - len(t) + 1))
            for kind in kinds[t] if n else []:
                want[(r.hadm_id, " ".join(t), kind)] += n
    got = {(r.hadm_id, r.term, r.kind): r.n for r in en.dictionary_mentions(notes, dictionary).collect()}
    assert got == dict(want)


def test_large_dictionaries_are_joined(spark, monkeypatch):
    notes = spark.createDataFrame([(1, "Acute renal failure, renal failure"), (2, None)], "hadm_id long, text string")
    dictionary = spark.createDataFrame([("renal failure", "disease"), ("acute", "symptom")], "term string, kind string")
    want = sorted(map(tuple, en.dictionary_mentions(notes, dictionary).collect()))
    monkeypatch.setattr(en, "MAX_BROADCAST_TERMS", 1)
    assert sorted(map(tuple, en.dictionary_mentions(notes, dictionary).collect())) == want


def test_a_task_looks_at_few_tokens_together(spark, monkeypatch):
    """Memory of a task does not follow its batches: notes are looked at in parts, and the counts are those of whole notes."""
    from casegraph.operators import automaton as at

    def watched(self, numbers, text):
        assert len(numbers) <= 50 or len(set(text.tolist())) == 1, "too many tokens together"
        return find(self, numbers, text)

    find = at.TermAutomaton.find
    monkeypatch.setattr(at.TermAutomaton, "find", watched)
    monkeypatch.setattr(en, "TOKENS_AT_ONCE", 50)
    assert list(en._parts(np.array([0, 20, 20, 50, 51, 200, 210]), 50)) == [(0, 3), (3, 4), (4, 5), (5, 6)]
    texts = [None, "", "a b " * 40, *(["a b c"] * 30)]
    tokens = spark.createDataFrame([(i, x.split() if x is not None else None) for i, x in enumerate(texts)], "id int, tokens array<string>").coalesce(1)
    kinds = {("a",): ["symptom"], ("a", "b"): ["symptom", "disease"]}
    seen = []
    monkeypatch.setattr(type(tokens), "mapInArrow", lambda self, run, schema: seen.append(run) or self)
    en._automaton_counts(tokens, kinds)
    batch = tokens.toArrow().combine_chunks().to_batches()
    found = [r for part in seen[0](iter(batch)) for r in part.to_pylist()]
    want = [(i, t, k, x.split().count("a")) for i, x in enumerate(texts) if x for t, k in (("a", "symptom"), ("a b", "disease"), ("a b", "symptom"))]
    assert sorted((r["id"], r["term"], r["kind"], r["n"]) for r in found) == sorted(want)
