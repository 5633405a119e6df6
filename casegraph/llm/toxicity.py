"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents and unlabelled text are samples of bounded size; the share of toxic documents (the class
prior) is that of the labelled rows. The risk of calling unlabelled text toxic is corrected by the prior for the
positives it holds, and kept from going below zero. Linear numpy classifiers on how often a text has a word, or a word
with so many first bytes (for endings that change), are fitted to that risk from several seeds and averaged; a count
enters by its logarithm. Every document's whole text is scored where it is read.

* null or empty text: the score of a text without known words; a text is read whole, however long;
* repeated rows: scored alike; null ids are never learnt from;
* no confirmed positives: every score is the prior; no documents: no rows;
* columns named like a result are replaced.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegraph.llm.labelled import fold, sample_rows, texts_of
from casegraph.llm.words import LETTERS_DIGITS, LOWER, Slice, append_columns, find_words, hash_runs, slices


@dataclass(frozen=True)
class Settings:
    #: Bounds of the samples: confirmed positives, and unlabelled documents.
    max_positive: int = 3_000
    max_unlabelled: int = 10_000
    #: A feature is used if its share among positives differs from that in unlabelled text by so many standard errors.
    min_z: float = 4.0
    min_documents: int = 3
    classifiers: int = 3
    epochs: int = 60
    rate: float = 0.05
    l2: float = 1e-4
    batch: int = 512


#: Longer words count by their first so many bytes, too; chosen on folds of the training rows.
PREFIXES = (5, 6, 7)


def _features(piece: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every word of a slice, and of the beginnings of longer words; a beginning counts as that word."""
    data = LOWER[piece.data]
    words = find_words(piece, LETTERS_DIGITS, data)
    hashes, rows = [hash_runs(data, words.start, words.end)], [words.text]
    for length in PREFIXES:
        longer = words.end - words.start > length
        start = words.start[longer]
        hashes.append(hash_runs(data, start, start + length))
        rows.append(words.text[longer])
    return np.concatenate(hashes), np.concatenate(rows)


def _counted(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """The different features of each text, sorted, and how often it has them."""
    out = []
    for piece in slices(column):
        hashes, rows = _features(piece)
        order = np.argsort(rows, kind="stable")
        cuts = np.searchsorted(rows[order], np.arange(1, piece.n))
        out += [np.unique(h, return_counts=True) for h in np.split(hashes[order], cuts)]
    return out


@dataclass(frozen=True)
class Classifier:
    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    bias: float

    def score(self, column: pa.Array) -> dict[str, np.ndarray]:
        parts, n = [np.zeros(0)], len(self.features)
        for piece in slices(column):
            total = np.full(piece.n, self.bias)
            if n:
                hashes, rows = _features(piece)
                at = np.minimum(np.searchsorted(self.features, hashes), n - 1)
                known = self.features[at] == hashes
                pairs, times = np.unique(rows[known] * n + at[known], return_counts=True)
                total += np.bincount(pairs // n, weights=self.weights[pairs % n] * np.log2(1 + times), minlength=piece.n)
            parts.append(1 / (1 + np.exp(-np.clip(total, -500, 500))))
        return {"score": np.concatenate(parts)}


Counts = list[tuple[np.ndarray, np.ndarray]]


def _matrix(documents: Counts, features: np.ndarray) -> np.ndarray:
    """Logarithms of the counts of the chosen features in each document, and a one for the bias."""
    out = np.zeros((len(documents), len(features) + 1), dtype=np.float32)
    out[:, -1] = 1
    if len(features):
        for row, (own, times) in zip(out, documents):
            at = np.minimum(np.searchsorted(features, own), len(features) - 1)
            known = features[at] == own
            row[at[known]] = np.log2(1 + times[known])
    return out


def _chosen(texts: DataFrame, text: str, settings: Settings) -> np.ndarray:
    """Features that more, or fewer, positives have than unlabelled documents, beyond chance, sorted.

    They are counted where the texts are read; the driver receives the chosen ones alone.
    """
    numbers = {r["_positive"]: r["count"] for r in texts.groupBy("_positive").count().collect()}
    if len(numbers) < 2:
        return np.zeros(0, dtype=np.uint64)

    def features_of(column: pa.Array) -> dict[str, pa.Array]:
        return {"_features": pa.array([h.view(np.int64) for h, _ in _counted(column)], pa.list_(pa.int64()))}

    own = append_columns(texts, text, "_features array<bigint>", features_of, keep=["_positive"])
    in_p, in_u = (F.count_if(F.col("_positive") == flag) for flag in (True, False))
    counts = own.select("_positive", F.explode("_features").alias("feature")).groupBy("feature").agg(in_p.alias("p"), in_u.alias("u"))
    n_p, n_u = float(numbers[True]), float(numbers[False])
    both = (F.col("p") + F.col("u")) / (n_p + n_u)
    error = F.sqrt(both * (1 - both) * (1 / n_p + 1 / n_u))
    beyond = F.abs(F.col("p") / n_p - F.col("u") / n_u) > settings.min_z * F.greatest(error, F.lit(1e-12))
    chosen = counts.where((F.col("p") + F.col("u") >= settings.min_documents) & beyond).select("feature").collect()
    return np.sort(np.array([r["feature"] for r in chosen], dtype=np.int64).view(np.uint64))


def _fit(x_pos: np.ndarray, x_unl: np.ndarray, prior: float, settings: Settings, seed: int) -> np.ndarray:
    """Adam on the non-negative risk with the sigmoid loss; where the corrected part is negative, only it is undone."""
    rng = np.random.default_rng(seed)
    w = rng.normal(0, 0.01, x_pos.shape[1])
    first, second, step = np.zeros_like(w), np.zeros_like(w), 0
    n_batches = max(1, len(x_unl) // settings.batch)
    for _ in range(settings.epochs):
        of_pos = np.array_split(rng.permutation(len(x_pos)), n_batches)
        of_unl = np.array_split(rng.permutation(len(x_unl)), n_batches)
        for a, b in zip(of_pos, of_unl):
            p = x_pos[a if len(a) else rng.integers(0, len(x_pos), 1)]
            u = x_unl[b]
            s_p, s_u = 1 / (1 + np.exp(-p @ w)), 1 / (1 + np.exp(-u @ w))
            # loss of calling x positive: 1 - s; negative: s; both have the slope s (1 - s)
            slope_p, slope_u = (s_p * (1 - s_p)) @ p / len(p), (s_u * (1 - s_u)) @ u / len(u)
            corrected = s_u.mean() - prior * s_p.mean()
            of_negative = slope_u - prior * slope_p
            gradient = -prior * slope_p + of_negative if corrected >= 0 else -of_negative
            gradient = gradient + settings.l2 * np.append(w[:-1], 0)
            step += 1
            first = 0.9 * first + 0.1 * gradient
            second = 0.999 * second + 0.001 * gradient**2
            w = w - settings.rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return w


def fit(
    docs: DataFrame, labels: DataFrame, learn, id: str = "doc_id", text: str = "text", label: str = "toxic",
    settings: Settings = Settings(),
) -> Classifier:
    """Fit to rows where the condition ``learn`` holds. Of ``labels``, positives and their share are used."""
    known = labels.where(learn & F.col(label).isNotNull())
    prior = known.agg(F.avg((F.col(label) == 1).cast("double"))).first()[0] or 0.0
    prior = min(max(prior, 1e-4), 0.9)
    ids = sample_rows(known.where(F.col(label) == 1), id, settings.max_positive).withColumn("_positive", F.lit(True))
    ids = ids.union(sample_rows(docs.where(learn), id, settings.max_unlabelled).withColumn("_positive", F.lit(False)))

    texts = texts_of(docs.select(id, text), ids, id)
    features = _chosen(texts, text, settings)

    def counts_of(column: pa.Array) -> dict[str, pa.Array]:
        rows = [row.tobytes() for row in _matrix(_counted(column), features)]
        return {"_row": pa.array([zlib.compress(row, 1) for row in rows], pa.binary())}

    rows = append_columns(texts, text, "_row binary", counts_of, keep=["_positive"]).collect()  # bounded by the settings
    x = {flag: [np.frombuffer(zlib.decompress(r["_row"]), np.float32) for r in rows if r["_positive"] == flag] for flag in (True, False)}
    if not x[True] or not x[False]:
        return Classifier(np.zeros(0, dtype=np.uint64), np.zeros(0), float(np.log(prior / (1 - prior))))
    x_pos, x_unl = np.stack(x.pop(True)), np.stack(x.pop(False))
    w = np.mean([_fit(x_pos, x_unl, prior, settings, seed) for seed in range(settings.classifiers)], axis=0)
    return Classifier(features, w[:-1], float(w[-1]))


def score(docs: DataFrame, classifier: Classifier, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``."""
    scored = append_columns(docs, text, "score double", classifier.score, keep)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def held_out(id: str = "doc_id"):
    return fold(id, 5) == 0
