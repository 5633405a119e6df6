import random

import pytest
from pyspark.sql import functions as F

from casegraph.llm import line_dedup as ld


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(rng, text, n):
    text = list(text)
    for _ in range(n):
        at, kind = rng.randrange(len(text)), rng.randrange(3)
        if kind == 0:
            text[at] = rng.choice("abcé ")
        elif kind == 1:
            text.insert(at, rng.choice("abcé"))
        elif len(text) > 1:
            del text[at]
    return "".join(text)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_automaton_is_the_edit_distance(spark, edits):
    rng = random.Random(edits)
    rows = []
    for _ in range(400):
        a = "".join(rng.choice("abé") for _ in range(rng.randrange(1, 14)))
        rows.append((a, edited(rng, a, rng.randrange(0, 6))))
    rows.append(("same", "same"))
    frame = spark.createDataFrame(rows, "a string, b string")
    got = frame.withColumn("near", ld.within_edits(F.split("a", ""), F.split("b", ""), edits)).collect()
    assert all(r.near == (distance(r.a, r.b) <= edits) for r in got)


def near_lines(a, b, settings):
    edits = min(settings.edits, min(len(a), len(b)) // settings.chars_per_edit)
    return abs(len(a) - len(b)) <= edits and edits > 0 and distance(a, b) <= edits


def brute(docs, settings):
    """Text, lines and removed lines of each document, documents in order."""
    seen, first_of, out = [], {}, []
    for text in docs:
        lines, keep = (text.split("\n") if text is not None else []), []
        for line in lines:
            folded = line.strip(" ").lower()
            if not folded:
                keep.append(line)
                continue
            equal = folded in first_of
            near = not equal and any(near_lines(s, folded, settings) for s in seen)
            if not equal:
                first_of[folded] = 1
                seen.append(folded)
            if not equal and not near:
                keep.append(line)
        out.append((None if text is None else "\n".join(keep), len(lines), len(lines) - len(keep)))
    return out


@pytest.mark.parametrize("edits", [0, 2, 3])
def test_matches_brute_force(spark, edits):
    rng = random.Random(9)
    settings = ld.Settings(edits=edits)
    base = ["".join(rng.choice("abcdeé ") for _ in range(rng.randrange(15, 70))) for _ in range(40)] + ["short one", "a", " ", "Exactly repeated here"]
    docs = []
    for i in range(60):
        lines = [edited(rng, rng.choice(base), rng.randrange(0, 5)) for _ in range(rng.randrange(1, 5))]
        lines += [rng.choice(base).upper()] if i % 3 == 0 else []
        docs.append("\n".join(lines))
    docs += [None, "", "\n", docs[0], "x" * 100_000 + "\n" + base[0]]
    frame = spark.createDataFrame([(i, t, i) for i, t in enumerate(docs)], "doc_id long, text string, n_lines int")
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in ld.dedup_lines(frame, settings=settings).collect()}
    for i, want in enumerate(brute(docs, settings)):
        assert got[i] == want, i
    assert ld.dedup_lines(frame.limit(0)).count() == 0


def test_copies_can_be_left_whole(spark):
    text = "This line is long enough to take part.\nAnd this one is long enough as well, is it not."
    rows = [(1, text), (2, text), (3, text.split("\n")[0] + "\nSomething else of a good length that is new here, twice as long as the other."), (None, text), (2, text)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = ld.dedup_lines(frame, settings=ld.Settings(max_loss=0.5)).collect()
    assert sorted((str(r.doc_id), r.n_removed) for r in got) == [("1", 0), ("2", 0), ("2", 0), ("3", 1), ("None", 0)]


def test_many_near_lines_make_few_pairs(spark):
    """200 lines within two edits of each other: 199 go, by a pair each."""
    line = "A line that stands in very many documents, with another number in each of them:"
    frame = spark.createDataFrame([(i, line + chr(97 + i % 26) + chr(97 + i // 26)) for i in range(200)], "doc_id long, text string")
    lines = ld.lines_of(frame, "doc_id", "text")
    rows = ld.segment_rows(lines, ld.Settings())
    texts = lines.select(
        F.col("h1").alias("id"), F.struct("doc", "version", "line").alias("at"), ld.letter_counts().alias("counts"), F.split("folded", "").alias("letters")
    )
    rows = ld.with_first(rows, texts, ld.Settings())
    pairs = ld.near_pairs(rows, ld.Settings())
    assert pairs.count() < 600
    late = ld.verified(pairs, texts, ld.Settings())
    assert late.count() == 199 and ld.near_pairs(rows, ld.Settings(), late).count() == 0


def test_ring_code_counts_steps():
    assert len(set(ld.RING)) == 8
    for a in range(8):
        for b in range(8):
            assert bin(ld.RING[a] ^ ld.RING[b]).count("1") == min(abs(a - b), 8 - abs(a - b))


def test_columns_with_internal_names(spark):
    names = "_version _gone _doc _of _kept _cut _row row id hash gone kept doc version line at n_lines n_removed text_ key place".split()
    own = {n: i for i, n in enumerate(names)}
    frame = spark.createDataFrame(
        [(i, "The same line in both of the documents.", *own.values()) for i in (1, 2)], "doc_id long, text string, " + ", ".join(f"{n} int" for n in names)
    )
    got = ld.without_repeated_lines(frame)
    assert got.columns == frame.columns
    rows = {r.doc_id: r.asDict() for r in got.collect()}
    assert rows[1] == {"doc_id": 1, "text": "The same line in both of the documents."} | own
    assert rows[2] == {"doc_id": 2, "text": ""} | own


def test_tables_of_unchecked_size_are_not_broadcast(spark, monkeypatch):
    """Spark takes them for as small as their files."""
    rng, plans = random.Random(5), {}
    lines = ["".join(rng.choice("abcdefgh ") for _ in range(60)) for _ in range(40)]
    rows = [(i, "\n".join([edited(rng, rng.choice(lines), rng.randrange(3)) for _ in range(4)] + [lines[i % 7]])) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")

    def seen(rows, name):
        plans[name] = rows._jdf.queryExecution().executedPlan().toString()
        return materialize(rows, name)

    materialize = ld.materialize
    monkeypatch.setattr(ld, "materialize", seen)
    want = sorted(map(tuple, ld.dedup_lines(docs).collect()))
    for name in ("segments-and-first", "lines-near-the-first", "lines-near-others"):
        assert "SortMergeJoin" in plans[name] and "Broadcast" not in plans[name]
    plans.clear()
    cleaned = ld.dedup_lines(docs, settings=ld.Settings(max_broadcast=0))
    plans["result"] = cleaned._jdf.queryExecution().executedPlan().toString()
    assert not [name for name, plan in plans.items() if "Broadcast" in plan]
    assert sorted(map(tuple, cleaned.collect())) == want and sum(r[3] for r in want) > 60
