"""Host-level quality rules.

Rules are counted per document, failures are summed per host, each host's failure rate is shrunk towards all
hosts by a beta prior fitted to them, and the verdict on a host is joined back to its documents. The prior is fitted by
moments weighted by documents, without the spread that chance alone gives to small hosts.

* null or empty text: no words, fails ``too_short``;
* null host: a host of its own;
* repeated rows: every row counts and gets its own verdict;
* no rows: no rows;
* columns of the input named like a result are replaced, all others pass.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from casegraph.llm.columns import set_aside
from casegraph.llm.words import NON_SPACE, append_columns, chain, find_words, hash_runs, slices
from casegraph.session import fits

SYMBOLS = "#*$%&|<>"
WINDOW = 5
COUNTS = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"

_symbol = np.zeros(256, dtype=bool)
_symbol[[ord(c) for c in SYMBOLS]] = True


@dataclass(frozen=True)
class Limits:
    min_words: int = 10
    max_repeat_percent: int = 20
    max_symbol_percent: int = 10
    max_dup_line_percent: int = 30
    word_length: tuple[int, int] = (3, 10)
    #: A host is rejected if its shrunk rate of failing documents is above this.
    max_host_rate: float = 0.5
    #: Bounds of the weight of the prior, in documents.
    prior_weight: tuple[float, float] = (2.0, 1000.0)


def _repeated_words(hashes: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """Words of each text inside windows that the text has twice or more."""
    if len(hashes) < WINDOW:
        return np.zeros(n, dtype=np.int64)
    size = len(hashes) - WINDOW + 1
    window = chain(text[:size].astype(np.uint64), *(hashes[i : i + size] for i in range(WINDOW)))
    at = np.flatnonzero(text[:size] == text[WINDOW - 1 :])
    order = at[np.argsort(window[at])]
    same = window[order[1:]] == window[order[:-1]]
    again = np.zeros(len(order), dtype=bool)
    again[1:] |= same
    again[:-1] |= same
    edges = np.zeros(len(hashes) + 1, dtype=np.int64)
    edges[order[again]] += 1  # a window starts once at a word
    edges[order[again] + WINDOW] -= 1
    return np.bincount(text[np.cumsum(edges[:-1]) > 0], minlength=n).astype(np.int64)


def count_rules(column: pa.Array) -> dict[str, np.ndarray]:
    parts: dict[str, list[np.ndarray]] = {name.split()[0]: [] for name in COUNTS.split(", ")}
    for piece in slices(column):
        words = find_words(piece, NON_SPACE)
        hashes = hash_runs(piece.data, words.start, words.end)
        lines, repeated = np.zeros(piece.n, dtype=np.int64), np.zeros(piece.n, dtype=np.int64)
        raw = piece.data.tobytes()
        for i, (a, b) in enumerate(zip(piece.offsets[:-1].tolist(), piece.offsets[1:].tolist())):
            filled = [line for line in raw[a:b].split(b"\n") if line and not line.isspace()]
            lines[i], repeated[i] = len(filled), len(filled) - len(set(filled))
        first_bytes = NON_SPACE[piece.data] & ((piece.data & 0xC0) != 0x80)
        parts["n_words"].append(words.counts(piece.n))
        parts["word_chars"].append(piece.per_text(first_bytes))
        parts["n_symbols"].append(piece.per_text(_symbol[piece.data]))
        parts["n_lines"].append(lines)
        parts["n_dup_lines"].append(repeated)
        parts["n_repeat_words"].append(_repeated_words(hashes, words.text, piece.n))
    return {k: np.concatenate(v) if v else np.zeros(0, dtype=np.int64) for k, v in parts.items()}


def with_rules(docs: DataFrame, limits: Limits = Limits(), text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the counts, ``base_failed`` and ``failed`` (any rule)."""
    counted = append_columns(docs, text, COUNTS, count_rules, keep)
    n, short, long = F.col("n_words"), *limits.word_length
    base = (n < limits.min_words) | (100 * F.col("n_repeat_words") > limits.max_repeat_percent * n)
    others = (
        (100 * F.col("n_symbols") > limits.max_symbol_percent * n)
        | (F.col("word_chars") < short * n)
        | (F.col("word_chars") > long * n)
    )
    repeated = 100 * F.col("n_dup_lines") > limits.max_dup_line_percent * F.col("n_lines")
    return counted.withColumns({"base_failed": base, "doc_failed": base | others, "failed": base | others | repeated})


def _prior(hosts: DataFrame, limits: Limits) -> tuple[float, float]:
    """Mean and weight (in documents) of the beta prior of the hosts' failure rates.

    The spread of the rates, weighted by documents, is what chance gives (``k - 1`` for ``k`` hosts, in units of one
    document's variance) and what differs between hosts: a correlation of that size belongs to a prior of weight
    ``1 / correlation - 1``. Hosts that differ no more than by chance get the largest weight.
    """
    n, x = F.col("n_docs").cast("double"), F.col("n_failed").cast("double")
    k, docs, failed, squares, rates = hosts.agg(
        F.count(F.lit(1)), F.sum(n), F.sum(x), F.sum(n * n), F.sum(x * x / n)
    ).first()
    low, high = limits.prior_weight
    mean = failed / docs if docs else 0.0
    variance = mean * (1 - mean)
    room = docs - squares / docs - (k - 1) if docs else 0.0
    if variance <= 0 or room <= 0:
        return mean, high
    correlation = ((rates - failed * failed / docs) / variance - (k - 1)) / room
    return mean, min(high, max(low, 1 / correlation - 1)) if correlation > 0 else high


def host_verdicts(ruled: DataFrame, host: str, limits: Limits = Limits()) -> DataFrame:
    """Per host: documents, failures, the shrunk rate and ``host_rejected``."""
    hosts = ruled.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("failed").cast("long")).alias("n_failed")
    )
    mean, weight = _prior(hosts, limits)
    shrunk = (F.col("n_failed") + mean * weight) / (F.col("n_docs") + weight)
    return hosts.withColumn("host_rate", shrunk).withColumn("host_rejected", shrunk > limits.max_host_rate)


def join_verdicts(ruled: DataFrame, verdicts: DataFrame, host: str, max_broadcast: int = 100_000) -> DataFrame:
    """``ruled`` with ``kept``: no failure of its own that rejects it, and not on a rejected host.

    Only rejected hosts are joined. They are broadcast if they are at most ``max_broadcast``, a checked size;
    otherwise the shuffle is left to the optimiser, which splits a host with very many documents.
    """
    bad = verdicts.where("host_rejected").select(F.col("host").alias("_host"), F.lit(True).alias("_bad"))
    if fits(bad, max_broadcast):
        bad = F.broadcast(bad)
    joined = ruled.join(bad, ruled[host].eqNullSafe(bad["_host"]), "left")
    kept = ~F.col("doc_failed") & F.col("_bad").isNull()
    return joined.withColumn("kept", kept).drop("_host", "_bad")


def keep_documents(docs: DataFrame, host: str = "source", limits: Limits = Limits()) -> DataFrame:
    """The documents that pass, with their own columns."""
    verdicts = host_verdicts(with_rules(docs, limits, keep=[host]), host, limits)
    made = [f.name for f in StructType.fromDDL(COUNTS)] + ["base_failed", "doc_failed", "failed", "kept", "_host", "_bad"]
    aside, restore = set_aside(docs, made)
    # the text's rules are computed again rather than shuffled or stored with the texts
    return restore(join_verdicts(with_rules(aside, limits), verdicts, host).where("kept"))
