import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from casegraph.llm import token_files as tf
from casegraph.llm.packing import Piece, assign, pack
from casegraph.llm.queries import QUERIES
from casegraph.llm.tokens import Encoder, default_path

SF = "/root/testdata/sf0.001"
ODD = ["", None, " a  b", "a \n b", "x\n\ny", "\n", " ", "a  b c", "it's I'll\n's <|endoftext|> 12 é́ \t q", "a\nb", "a b\n", "\x1c x \x1cy"]


def plain(texts):
    tokenizer = Tokenizer.from_file(default_path())
    tokenizer.encode_special_tokens = True
    return [x.ids for x in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_parts_give_the_ids_of_the_whole_text(spark):
    texts = ODD + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    small = Encoder(default_path(), max_remembered=50)
    for encoder in (small, Encoder(default_path())):
        got = [np.frombuffer(b, dtype="<u4").tolist() for b in encoder.encode(texts)]
        assert got == plain(texts)
    assert len(small.known) <= 50


def test_only_parts_that_come_again_take_room():
    encoder = Encoder(default_path(), max_remembered=50)
    numbered = ["z" + "".join(chr(97 + int(c)) for c in str(i)) for i in range(3000)]
    again = ["again", "a", "third"]
    texts = [" ".join([*numbered[i : i + 30], *again]) for i in range(0, 3000, 30)]
    for text in texts:
        assert encoder.encode([text]) == [np.array(plain([text])[0], dtype="<u4").tobytes()]
    assert set(again) <= set(encoder.known) and len(encoder.known) < 50


def test_words_with_marks_give_the_ids_of_the_whole_text():
    rng = np.random.default_rng(5)
    alphabet = list("aZéßǅʼ'.,$!²½1xsd ’Ω语\n \t\u00a0\u2003\u3000") + ["word", " ", "\n"] * 3
    texts = ["".join(rng.choice(alphabet, size=n)) for n in rng.integers(0, 40, 3000)]
    texts += ["Ünïté&&& \"so\" it's. don't!' x.'s\nÉtat$$$ *** a<|endoftext|>b", None, ""]
    for encoder in (Encoder(default_path()), Encoder(default_path(), max_remembered=20, met_places=8)):
        for at in range(0, len(texts), 100):
            got = encoder.encode(texts[at : at + 100])
            assert got == [np.array(ids, dtype="<u4").tobytes() for ids in plain(texts[at : at + 100])]


def check_packed(rows, docs):
    ids = {d: i + [0] for d, i in zip(docs, plain(docs.values()))}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(docs)
    for doc, own in pieces.items():
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids[doc])
            assert r.ids_crc32 == crc(ids[doc][at : at + r.length])
            at += r.length
        assert at == len(ids[doc])
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == 1024 or (at < 1024 and at & (at - 1) == 0)


def test_packing_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    check_packed(QUERIES["op2_packing"](spark, SF).collect(), docs)


def test_packing_odd_rows(spark):
    docs = dict(enumerate(ODD + ["many words " * 9000]))
    frame = spark.createDataFrame([(i, t, "s") for i, t in docs.items()], "doc_id long, text string, sequence_id string").repartition(3)
    for block in (300, 1 << 20):
        check_packed(pack(frame, block_tokens=block).selectExpr("*", "crc32(ids) AS ids_crc32").collect(), docs)
    assert pack(frame.limit(0)).count() == 0


def test_costs_are_balanced():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 900, 400)
    pieces = [Piece(i, 0, int(n), int(n), memoryview(b"abcd" * int(n))) for i, n in enumerate(lengths)]
    full = int(lengths.sum()) // 1024
    members, rest = assign(pieces, [1024] * full, 1.0, 1 / 4096)
    assert all(sum(p.length for p in m) == 1024 for m in members)
    assert sum(p.length for p in rest) == int(lengths.sum()) - 1024 * full
    squares = [sum(p.length**2 for p in m) for m in members]
    first_fit, open_ = [], []
    for n in lengths.tolist():
        for s in open_:
            if sum(s) + n <= 1024:
                s.append(n)
                break
        else:
            open_.append([n])
    first_fit = [sum(n**2 for n in s) for s in open_]
    assert np.std(squares) < np.std(first_fit)


def expected_files(docs):
    start, out = 0, {}
    for doc, ids in sorted(zip(docs, plain(docs.values()))):
        out[doc] = (start, len(ids) + 1, crc(ids + [0]))
        start += len(ids) + 1
    return out


def test_files_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op8_token_files"](spark, SF).collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in rows} == expected_files(docs)


def test_files_odd_rows(spark):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(None, "no id", "y"), (3, "again", "z"), (50, "long text " * 20_000, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, base string").repartition(4)
    folder = tf.new_folder(frame)
    got = tf.read_files(tf.write_files(frame, folder), folder).orderBy("start").collect()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    assert [r.doc_id for r in got] == [r[0] for r in ordered]
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in got] == [i + [0] for i in plain([r[1] for r in ordered])]
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    folder = tf.new_folder(frame)
    assert tf.read_files(tf.write_files(frame.limit(0), folder), folder).count() == 0
