"""Importance resampling towards a target text, with n-gram features hashed into buckets.

Features of a text are all runs of one to three words; a feature's bucket is its CRC-32 modulo the number of buckets.
A bucket gains what the target has more of it than the corpus, as a logarithm; a document weighs the sum over its
features; Gumbel noise from a hash of its id makes the highest scores a sample without replacement.

Counting the corpus goes by segments: newlines separate words, so they cut texts into lines whose features do not depend
on what stands around them. Equal lines are grouped first (partial counts before the shuffle, so a line that a third of
all documents share is a row per task); the features of each different line are counted once and multiplied by its
occurrences. The runs that reach over a line's end are counted per document and added.

CRC-32 is linear: the checksum of two words in a row follows from those of the words and their lengths. So words are
read once, and checksums of longer runs come from table look-ups on whole arrays.

* null or empty text, or no words: no features, weight 0, too short to be drawn;
* null ids: hashed as an empty text, before all others in ties;
* repeated rows are documents of their own; they have equal scores and ranks next to each other;
* an empty target: every gain follows from zero counts; no documents: no rows;
* columns of the input named like a result are replaced, others are kept on request.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegraph.llm.words import LETTERS_DIGITS, LOWER, Slice, append_columns, find_words, slices
from casegraph.operators.ranking import positions
from casegraph.session import materialize


@dataclass(frozen=True)
class Settings:
    buckets: int = 10_000
    longest: int = 3
    seed: int = 42
    #: Documents with fewer words are never drawn.
    min_words: int = 20
    #: Share of the others that is drawn, in percent.
    percent: int = 5


# ---- checksums of runs of words

_MASK = np.uint32(0xFF)
_BYTE = np.uint32(8)


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & np.uint32(1), (table >> np.uint32(1)) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table


CRC = _byte_table()
_NEAR = 64  # lengths up to this are looked up at once


def _append_zero(state: np.ndarray) -> np.ndarray:
    return CRC[state & _MASK] ^ (state >> _BYTE)


def _zero_tables() -> np.ndarray:
    """For n = 0.._NEAR: what n zero bytes make of a state, by each of the state's four bytes."""
    bytes_ = np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * _BYTE)[:, None]
    out = [bytes_]
    for _ in range(_NEAR):
        out.append(_append_zero(out[-1]))
    return np.stack(out)


_ZEROS = _zero_tables()


def _shift(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """States after ``n`` zero bytes."""
    near = np.minimum(n, _NEAR)
    out = _ZEROS[near, 0, crc & _MASK]
    for byte in range(1, 4):
        out ^= _ZEROS[near, byte, (crc >> np.uint32(8 * byte)) & _MASK]
    far = np.flatnonzero(n > _NEAR)
    if len(far):
        out[far] = _shift_far(out[far], n[far] - _NEAR)
    return out


def _shift_far(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """As ``_shift`` for any length, by powers of two."""
    table, step = _ZEROS[1], 0
    while (n >> step).any():
        odd = np.flatnonzero((n >> step) & 1)
        crc[odd] = _look_up(table, crc[odd])
        table = np.stack([_look_up(table, row) for row in table])  # twice as many zeros
        step += 1
    return crc


def _look_up(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    out = table[0, crc & _MASK]
    for byte in range(1, 4):
        out = out ^ table[byte, (crc >> np.uint32(8 * byte)) & _MASK]
    return out


def word_checksums(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of each run of bytes: all words move on by a byte at a time, the longest first; giant words one by one."""
    length = end - start
    order = np.argsort(-length, kind="stable")
    first, size = start[order], length[order]
    crc = np.full(len(start), 0xFFFFFFFF, dtype=np.uint32)
    giants = int(np.searchsorted(-size, -_NEAR, side="left"))
    for at in range(int(size[giants]) if giants < len(size) else 0):
        stop = int(np.searchsorted(-size, -at, side="left"))
        state = crc[giants:stop]
        crc[giants:stop] = CRC[(state ^ data[first[giants:stop] + at]) & _MASK] ^ (state >> _BYTE)
    crc = ~crc
    for i in range(giants):
        crc[i] = zlib.crc32(data[first[i] : first[i] + size[i]])
    out = np.empty_like(crc)
    out[order] = crc
    return out


def features(piece: Slice, longest: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each number of words: bucket and text of the runs, and whether a run reaches over the end of a line."""
    data = LOWER[piece.data]
    words = find_words(piece, LETTERS_DIGITS, data)
    own = word_checksums(data, words.start, words.end)
    behind = words.end - words.start + 1  # with the space before the word
    with_space = _shift(np.full(len(own), zlib.crc32(b" "), dtype=np.uint32), behind - 1) ^ own
    breaks = np.cumsum(data == 0x0A)
    line = breaks[words.start] if len(own) else np.zeros(0, dtype=np.int64)
    run = own
    for n in range(1, longest + 1):
        if n > 1:
            run = _shift(run[: max(len(run) - 1, 0)], behind[n - 1 :]) ^ with_space[n - 1 :]
        last = np.arange(n - 1, n - 1 + len(run))
        inside = words.text[: len(run)] == words.text[last]
        over = line[: len(run)] != line[last]
        yield run[inside].astype(np.int64) % buckets, words.text[: len(run)][inside], over[inside]


# ---- counts


def _counted(batches: Iterator[pa.RecordBatch], settings: Settings, add) -> Iterator[pa.RecordBatch]:
    """Bucket counts of a task; ``add`` gives the counts of a batch."""
    total = np.zeros(settings.buckets, dtype=np.int64)
    for batch in batches:
        for part in add(batch):
            total += part
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])


def line_counts(texts: DataFrame, settings: Settings) -> DataFrame:
    """``bucket, n`` of the features inside lines: of each different line once, times its occurrences."""
    lines = texts.select(F.explode(F.split("text", "\n")).alias("line"))
    different = lines.groupBy("line").agg(F.count(F.lit(1)).alias("times"))

    def add(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        times = batch.column(1).to_numpy(zero_copy_only=False)
        for piece in slices(batch.column(0)):
            for bucket, text, _ in features(piece, settings.longest, settings.buckets):
                # exact: sums stay far below 2**53
                yield np.bincount(bucket, times[piece.first + text], settings.buckets).astype(np.int64)

    return different.mapInArrow(lambda batches: _counted(batches, settings, add), "bucket long, n long")


def crossing_counts(texts: DataFrame, settings: Settings) -> DataFrame:
    """``bucket, n`` of the features that reach over the end of a line."""

    def add(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for piece in slices(batch.column(0)):
            for bucket, _, over in features(piece, settings.longest, settings.buckets):
                yield np.bincount(bucket[over], minlength=settings.buckets)

    return texts.select("text").mapInArrow(lambda batches: _counted(batches, settings, add), "bucket long, n long")


def bucket_counts(docs: DataFrame, text: str, settings: Settings) -> np.ndarray:
    """Features of all texts in each bucket; the driver sees a number per bucket."""
    texts = docs.select(F.col(text).alias("text"))
    counted = line_counts(texts, settings).union(crossing_counts(texts, settings))
    out = np.zeros(settings.buckets, dtype=np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the natural logarithm of each bucket's smoothed share in the target over that in the corpus."""
    n, all_corpus, all_target = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((t + 1) * (all_corpus + n) / ((s + 1) * (all_target + n))))
            for s, t in zip(corpus.tolist(), target.tolist())
        ],
        dtype=np.int64,
    )


# ---- documents


def weigh(docs: DataFrame, gains: np.ndarray, text: str, settings: Settings, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``n_words``, ``n_features`` and ``weight``."""

    def compute(column: pa.Array) -> dict[str, np.ndarray]:
        n = len(column)
        out = {name: np.zeros(n, dtype=np.int64) for name in ("n_words", "n_features", "weight")}
        for piece in slices(column):
            rows = slice(piece.first, piece.first + piece.n)
            for length, (bucket, of, _) in enumerate(features(piece, settings.longest, settings.buckets), 1):
                counts = np.bincount(of, minlength=piece.n)
                if length == 1:
                    out["n_words"][rows] = counts
                out["n_features"][rows] += counts
                out["weight"][rows] += np.bincount(of, gains[bucket], piece.n).astype(np.int64)
        return out

    return append_columns(docs, text, "n_words long, n_features long, weight long", compute, keep)


def with_scores(weighed: DataFrame, id: str, settings: Settings) -> DataFrame:
    """``weighed`` with ``score``: the weight plus Gumbel noise from a hash of the id."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{settings.seed}:"), F.coalesce(F.col(id).cast("string"), F.lit(""))), 256), 1, 8)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296.0
    return weighed.withColumn("score", F.col("weight") + F.floor(-1000 * F.log(-F.log(u))))


def resample(
    docs: DataFrame, target: DataFrame, id: str = "doc_id", text: str = "text", settings: Settings = Settings(),
    keep: list[str] | None = None,
) -> DataFrame:
    """Rows of ``docs`` (or their columns ``keep``) with ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank``,
    which is null where a row is not drawn."""
    results = ["n_words", "n_features", "weight", "score", "rank"]
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in results] or [id]
    gains = bucket_gains(bucket_counts(docs, text, settings), bucket_counts(target, text, settings))
    # the columns of the input travel in one, so that none can clash
    packed = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), F.struct(*kept).alias("row"))
    scored = materialize(with_scores(weigh(packed, gains, "text", settings, ["id", "row"]), "id", settings), "scored-documents")
    long = scored.where(F.col("n_words") >= settings.min_words)
    drawn = settings.percent * long.count() // 100
    placed = positions(long.withColumn("above", -F.col("score")), ["above", "id"], "place").drop("above")
    rank = F.when(F.col("place") < drawn, F.col("place") + 1)
    short = scored.where(F.col("n_words") < settings.min_words).withColumn("rank", F.lit(None).cast("long"))
    return placed.withColumn("rank", rank).drop("place").unionByName(short).select("row.*", *results)


def draw(docs: DataFrame, target: DataFrame, id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """The drawn rows of ``docs``, texts included, with their results."""
    return resample(docs, target, id, text, settings).where(F.col("rank").isNotNull())
