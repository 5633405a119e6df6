"""A factorisation machine for text quality.

Features are hashed words (weighted by their share, unit length per text), the structure of the text in quantile
bins, and its length as metadata. A score is a bias, a weight per feature, and for every pair of features the
product of their low-rank vectors; the pairs are summed in linear time as half of (square of the sum minus the sum
of squares). The machine is fitted in numpy to a sample of labelled rows of bounded size, and scores every
document's whole text where it is read.

* null or empty text: scored by its structure alone;
* repeated rows: scored alike; null ids and null labels are never learnt from;
* no labelled rows: every score is one half; no documents: no rows;
* columns named like a result are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegraph.llm.labelled import fold, sample_rows, texts_of
from casegraph.llm.quality_rules import count_rules
from casegraph.llm.words import LOWER, NON_SPACE, append_columns, find_words, hash_runs, slices


@dataclass(frozen=True)
class Settings:
    #: Bound of the sample of labelled documents.
    max_documents: int = 12_000
    buckets: int = 1 << 14
    bins: int = 8
    rank: int = 8
    epochs: int = 6
    #: More epochs are run over a small sample, until so many steps are done.
    min_steps: int = 600
    batch: int = 128
    rate: float = 0.01
    l2: float = 1e-5


_UPPER = np.zeros(256, dtype=bool)
_UPPER[0x41:0x5B] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[0x30:0x3A] = True
_END = np.zeros(256, dtype=bool)
_END[[ord(c) for c in ".!?"]] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True


def describe(column: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Structure of each text (a row of numbers), and hashed words as text, bucket and weight."""
    rules = count_rules(column)
    chars, rows, text, bucket, weight = [], [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
    for piece in slices(column):
        data = LOWER[piece.data]
        words = find_words(piece, NON_SPACE, data)
        at = (hash_runs(data, words.start, words.end) % np.uint64(buckets)).astype(np.int64)
        pairs, count = np.unique(words.text * buckets + at, return_counts=True)
        own = pairs // buckets
        length = np.sqrt(np.bincount(own, weights=count.astype(float) ** 2, minlength=piece.n))
        text.append(own + piece.first)
        bucket.append(pairs % buckets)
        weight.append(count / length[own])
        different = np.bincount(own, minlength=piece.n)
        capital = piece.per_text(_UPPER[piece.data])
        capital_words = np.bincount(words.text[_UPPER[piece.data][words.start]], minlength=piece.n) if len(words.start) else capital * 0
        chars.append(piece.per_text((piece.data & 0xC0) != 0x80))
        counts = [capital, piece.per_text(_DIGIT[piece.data]), piece.per_text(_MARK[piece.data]), piece.per_text(_END[piece.data])]
        rows.append(np.stack([*counts, capital_words, different]))
    if not rows:
        return np.zeros((0, 13)), text[0], bucket[0], weight[0]
    chars = np.concatenate(chars)
    capital, digit, mark, end, capital_words, different = np.concatenate(rows, axis=1)
    n, c = np.maximum(rules["n_words"], 1), np.maximum(chars, 1)
    structure = np.stack(
        [
            np.log1p(chars),  # metadata: the length
            np.log1p(rules["n_words"]),
            rules["word_chars"] / n,
            rules["n_symbols"] / n,
            rules["n_dup_lines"] / np.maximum(rules["n_lines"], 1),
            rules["n_repeat_words"] / n,
            rules["n_words"] / np.maximum(rules["n_lines"], 1),
            capital / c,
            digit / c,
            mark / c,
            end / n,
            capital_words / n,
            different / n,
        ],
        axis=1,
    )
    return structure, np.concatenate(text), np.concatenate(bucket), np.concatenate(weight)


@dataclass(frozen=True)
class Machine:
    """Features are buckets of words, then bins of the structure."""

    edges: np.ndarray  # per number of the structure, ascending
    buckets: int
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def features(self, structure: np.ndarray) -> np.ndarray:
        bins = np.stack([np.searchsorted(e, x, side="right") for e, x in zip(self.edges, structure.T)], axis=1)
        return self.buckets + bins + np.arange(bins.shape[1]) * (self.edges.shape[1] + 1)

    def score(self, column: pa.Array) -> dict[str, np.ndarray]:
        parts = [np.zeros(0)]
        for at in range(0, len(column), 256):
            structure, text, bucket, weight = describe(column.slice(at, 256), self.buckets)
            n, places = len(structure), self.features(structure)
            linear = self.bias + self.weights[places].sum(axis=1)
            linear += np.bincount(text, weights=self.weights[bucket] * weight, minlength=n)
            sums, squares = self.vectors[places].sum(axis=1), (self.vectors[places] ** 2).sum(axis=(1, 2))
            for f in range(self.vectors.shape[1]):
                product = self.vectors[bucket, f] * weight
                sums[:, f] += np.bincount(text, weights=product, minlength=n)
                squares += np.bincount(text, weights=product**2, minlength=n)
            total = linear + 0.5 * ((sums**2).sum(axis=1) - squares)
            parts.append(1 / (1 + np.exp(-np.clip(total, -500, 500))))
        return {"score": np.concatenate(parts)}


def _train(samples: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, size: int, settings: Settings):
    """Adam on the logistic loss; only rows of features that a batch has are touched."""
    rng = np.random.default_rng(7)
    # the weight and the vector of a feature side by side
    table = np.concatenate([np.zeros((size, 1)), rng.normal(0, 0.05, (size, settings.rank))], axis=1)
    share = min(max(labels.mean(), 0.01), 0.99)
    bias = float(np.log(share / (1 - share)))
    first, second = np.zeros_like(table), np.zeros_like(table)
    step = 0
    epochs = max(settings.epochs, -(-settings.min_steps * settings.batch // len(samples)))
    for _ in range(epochs):
        order = rng.permutation(len(samples))
        for at in range(0, len(order), settings.batch):
            chosen = order[at : at + settings.batch]
            own = [samples[i] for i in chosen]
            place = np.concatenate([p for p, _ in own])
            x = np.concatenate([v for _, v in own])[:, None]
            sizes = np.array([len(p) for p, _ in own])
            begin, doc = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(own)), sizes)
            used, back = np.unique(place, return_inverse=True)
            v = table[used, 1:][back] * x
            sums = np.add.reduceat(v, begin)
            pairs = 0.5 * ((sums**2).sum(axis=1) - np.add.reduceat(v**2, begin).sum(axis=1))
            total = bias + np.add.reduceat(table[used, 0][back] * x[:, 0], begin) + pairs
            error = (1 / (1 + np.exp(-np.clip(total, -500, 500))) - labels[chosen]) / len(own)
            slope = np.concatenate([x, x * (sums[doc] - v)], axis=1) * error[doc][:, None]
            gradient = np.stack([np.bincount(back, weights=s, minlength=len(used)) for s in slope.T], axis=1)
            gradient += settings.l2 * table[used]
            step += 1
            first[used] = 0.9 * first[used] + 0.1 * gradient
            second[used] = 0.99 * second[used] + 0.01 * gradient**2
            change = first[used] / (1 - 0.9**step) / (np.sqrt(second[used] / (1 - 0.99**step)) + 1e-8)
            table[used] -= settings.rate * change
            bias -= settings.rate * float(error.sum())
    return bias, table[:, 0].copy(), table[:, 1:].copy()


def fit(
    docs: DataFrame, labels: DataFrame, learn, id: str = "doc_id", text: str = "text", label: str = "quality",
    settings: Settings = Settings(),
) -> Machine:
    """Fit to labelled rows where the condition ``learn`` holds."""
    known = labels.where(learn & F.col(label).isNotNull())
    ids = sample_rows(known, id, settings.max_documents)
    marked = known.join(F.broadcast(ids), id).groupBy(id).agg(F.max((F.col(label) == 1).cast("double")).alias("_label"))

    def described(column: pa.Array) -> dict[str, pa.Array]:
        structure, words, values = [], [], []
        for at in range(0, len(column), 256):
            s, text, bucket, weight = describe(column.slice(at, 256), settings.buckets)
            cuts = np.searchsorted(text, np.arange(len(s) + 1))
            structure += [row.tobytes() for row in s]
            words += [bucket[a:b].astype("<u4").tobytes() for a, b in zip(cuts, cuts[1:])]
            values += [weight[a:b].astype("<f4").tobytes() for a, b in zip(cuts, cuts[1:])]
        return {"_s": pa.array(structure, pa.binary()), "_w": pa.array(words, pa.binary()), "_x": pa.array(values, pa.binary())}

    sampled = texts_of(docs.select(id, text), marked, id)
    rows = append_columns(sampled, text, "_s binary, _w binary, _x binary", described, keep=["_label"]).collect()
    if not rows:
        return Machine(np.zeros((13, 1)), settings.buckets, 0.0, *_empty(settings, 13 * 2))
    structure = np.stack([np.frombuffer(r["_s"]) for r in rows])
    quantiles = np.arange(1, settings.bins) / settings.bins
    edges = np.quantile(structure, quantiles, axis=0).T
    # the last edges look at the tail, where faults are
    edges = np.concatenate([edges, np.quantile(structure, [0.95, 0.99], axis=0).T], axis=1)
    machine = Machine(np.sort(edges, axis=1), settings.buckets, 0.0, *_empty(settings, 0))
    places = machine.features(structure)
    samples = [
        (
            np.concatenate([np.frombuffer(r["_w"], "<u4").astype(np.int64), own]),
            np.concatenate([np.frombuffer(r["_x"], "<f4"), np.ones(len(own))]),
        )
        for r, own in zip(rows, places)
    ]
    labels_ = np.array([r["_label"] for r in rows])
    size = settings.buckets + structure.shape[1] * (edges.shape[1] + 1)
    return Machine(machine.edges, settings.buckets, *_train(samples, labels_, size, settings))


def _empty(settings: Settings, more: int) -> tuple[np.ndarray, np.ndarray]:
    return np.zeros(settings.buckets + more), np.zeros((settings.buckets + more, settings.rank))


def score(docs: DataFrame, machine: Machine, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``."""
    scored = append_columns(docs, text, "score double", machine.score, keep)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def held_out(id: str = "doc_id"):
    return fold(id, 3) == 1
