import re
import string

import numpy as np
import pytest

import corpus_pipeline as cp
from casegraph.llm.line_dedup import Settings
from casegraph.llm.queries import ORACLES
from oracle import connect
from test_decontaminate import WORD, brute as brute_decontamination
from test_line_dedup import brute as brute_lines
from test_simhash import brute_components, brute_fingerprint
from test_tokens import plain

SF = "/root/testdata/sf0.001"
LOWER = {ord(c): c.lower() for c in string.ascii_uppercase}


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows after each stage."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    columns = docs.columns
    for i, (_, stage) in enumerate(cp.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / "rows")
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        assert i == len(cp.STAGES) - 1 or docs.columns == columns
        out.append(docs.collect())
    return out


def test_quality_rules(stages):
    kept = connect(SF).execute(f"SELECT doc_id FROM ({ORACLES['op4_quality_rules']}) WHERE kept ORDER BY 1").fetchall()
    assert sorted(r.doc_id for r in stages[0]) == [k for (k,) in kept]


def test_line_dedup(stages):
    before = sorted(stages[0], key=lambda r: r.doc_id)
    want = {r.doc_id: text for r, (text, _, _) in zip(before, brute_lines([r.text for r in before], Settings()))}
    assert {r.doc_id: r.text for r in stages[1]} == want
    assert all(r.n_chars == len(r.text) for r in stages[1])


def test_near_duplicates(stages):
    ids = [r.doc_id for r in stages[1]]
    first = brute_components(ids, [brute_fingerprint(r.text) for r in stages[1]])
    assert sorted(r.doc_id for r in stages[2]) == sorted(i for i in ids if first[i] == i)


def test_decontamination(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    after = {r.doc_id: r.text for r in stages[3]}
    for r, (_, hit, _) in zip(stages[2], brute_decontamination([r.text for r in stages[2]], items)):
        spans = [m.span() for m in re.finditer(WORD, r.text.translate(LOWER))]
        gone = np.zeros(len(r.text), dtype=bool)
        for i in hit:
            gone[spans[i][0] : spans[i + 1][0] if i + 1 in hit else spans[i][1]] = True
        assert after[r.doc_id] == "".join(c for c, g in zip(r.text, gone) if not g)
    assert len(after) == len(stages[2])


def test_packing(stages):
    ids = {r.doc_id: i + [0] for r, i in zip(stages[3], plain([r.text for r in stages[3]]))}
    got = {}
    for r in sorted(stages[4], key=lambda r: r.start):
        got.setdefault(r.doc_id, []).extend(np.frombuffer(r.ids, "<u4").tolist())
    assert got == ids


def test_run_is_the_stages(spark, stages):
    assert cp.run(spark, SF).count() == len(stages[4])


# every name the stages use for themselves
NAMES = (
    "n_words items _version _gone _doc _of _kept _cut _host _bad _row _set row id hash gone kept doc version line failed base_failed "
    "doc_failed n_lines n_removed fingerprint fingerprint_bits component_id root least n_hit spans word_chars n_symbols _own_kept"
).split()


def test_clashing_and_extra_columns(spark):
    rows = [(i, f"Some words of text number {i} that are long enough to pass the rules.", "x", None, *["own"] * len(NAMES)) for i in range(5)]
    rows += [(9, None, None, None, *["own"] * len(NAMES)), (10, "", "x", None, *["own"] * len(NAMES))]
    docs = spark.createDataFrame(rows + rows[:1], "doc_id long, text string, source string, n_chars long, " + ", ".join(f"{n} string" for n in NAMES))
    for _, stage in cp.STAGES[:-1]:
        got = stage(spark, docs, SF)
        assert got.columns == docs.columns
        assert {tuple(r[n] for n in NAMES) for r in got.collect()} == {("own",) * len(NAMES)}
        assert stage(spark, docs.limit(0), SF).count() == 0
