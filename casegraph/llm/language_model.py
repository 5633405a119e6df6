"""An interpolated modified Kneser-Ney bigram model, counted in Spark and memory-mapped by the workers that score.

Tokens are lower-cased words and one end per text. Counting takes two passes: words, then pairs of word numbers.
Each pass adds up blocks of tokens before the shuffle, which deals them out by ranges of a hash, so that a frequent
word or pair is one entry of a block and no range is larger than another. Every range is written as flat arrays:

* words: sorted 64-bit hashes and counts; a word's number is its place in all ranges;
* pairs: sorted hashes of (previous word, word), a one-to-one hash of the two numbers, and counts;
* per word: the number of different words before it, and as context its count and its back-off weight.

Nothing is sampled or pruned, so the model grows with the corpus. Lookups are binary searches of sorted blocks of
distinct keys, so they go through the arrays in order.

* null or empty text: the end token only, after the start of a text;
* repeated rows count as often as they occur; null ids are training documents;
* no training documents: every token has the probability of an unknown one;
* columns named like a result are replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casegraph.llm.shared_files import map_array, write_array
from casegraph.llm.words import LOWER, NON_SPACE, Slice, find_words, hash_runs, mix, slices
from casegraph.session import materialize, shared_folder

END = np.uint64(0x5E4D)  # stands for the end of a text among word hashes
BLOCK_TOKENS = 1 << 20  # counted at once
SCORE_TOKENS = 1 << 19  # scored at once
SHARD_BYTES = 16 << 20  # text per range
_U32 = np.uint64(32)


def training(id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id).cast("string")) % 7 != 2, F.lit(True))


def tokens_of(piece: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes of the texts of a slice, the text of each, and the first token of each text."""
    data = LOWER[piece.data]
    words = find_words(piece, NON_SPACE, data)
    counts = words.counts(piece.n) + 1
    tokens = np.full(int(counts.sum()), END, dtype=np.uint64)
    tokens[np.arange(len(words.start)) + words.text] = hash_runs(data, words.start, words.end)
    return tokens, np.repeat(np.arange(piece.n), counts), np.cumsum(counts) - counts


def _range_of(keys: np.ndarray, n: int) -> np.ndarray:
    return ((keys >> _U32) * np.uint64(n)) >> _U32


def _unmix(h: np.ndarray) -> np.ndarray:
    """The inverse of ``words.mix``."""
    h = h ^ (h >> np.uint64(31)) ^ (h >> np.uint64(62))
    h = h * np.uint64(pow(0x94D049BB133111EB, -1, 1 << 64))
    h = h ^ (h >> np.uint64(27)) ^ (h >> np.uint64(54))
    h = h * np.uint64(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
    return h ^ (h >> np.uint64(30)) ^ (h >> np.uint64(60))


def _pieces(keys: np.ndarray, values: list[np.ndarray], bounds: np.ndarray) -> pa.RecordBatch:
    """A row per range that has keys: the range and its part of every array, as bytes. ``bounds`` cut the sorted keys."""
    used = np.flatnonzero(np.diff(bounds))
    columns = [pa.array(used, pa.int32())]
    for v in (keys, *values):
        columns.append(pa.array([v[bounds[i] : bounds[i + 1]].tobytes() for i in used.tolist()], pa.binary()))
    return pa.RecordBatch.from_arrays(columns, names=["shard", *(f"v{k}" for k in range(len(values) + 1))])


def _joined(group: pa.Table, name: str, kind) -> np.ndarray:
    return np.concatenate([np.frombuffer(x.as_buffer(), dtype=kind) for x in group.column(name)])


def _added_up(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[new], np.add.reduceat(counts.astype(np.int64), new)


def _name(kind: str, shard: int) -> str:
    return f"{kind}-{shard:06d}-{TaskContext.get().taskAttemptId()}"


@dataclass(frozen=True)
class Ranges:
    """Files of sorted keys, range by range: (name, number of keys)."""

    folder: str
    files: tuple[tuple[str, int], ...]

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum([0] + [n for _, n in self.files])

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each of the sorted keys in all ranges, or -1."""
        out = np.full(len(keys), -1, dtype=np.int64)
        n = len(self.files)
        bounds = np.searchsorted(_range_of(keys, n), np.arange(n + 1, dtype=np.uint64))
        starts = self.starts
        for i in np.flatnonzero(np.diff(bounds)).tolist():
            own = _mapped(self.folder, f"{self.files[i][0]}.key", "<u8") if self.files[i][1] else ()
            if not len(own):
                continue
            part = keys[bounds[i] : bounds[i + 1]]
            at = np.minimum(np.searchsorted(own, part), len(own) - 1)
            out[bounds[i] : bounds[i + 1]] = np.where(own[at] == part, at + starts[i], -1)
        return out

    def take(self, suffix: str, kind: str, places: np.ndarray) -> np.ndarray:
        """Values of an array beside the keys, at ascending places; 0 where the place is -1."""
        out = np.zeros(len(places), dtype=kind)
        known = np.flatnonzero(places >= 0)
        at = places[known]
        order = np.argsort(at, kind="stable")
        known, at = known[order], at[order]
        starts = self.starts
        bounds = np.searchsorted(at, starts)
        for i in np.flatnonzero(np.diff(bounds)).tolist():
            own = _mapped(self.folder, f"{self.files[i][0]}.{suffix}", kind)
            out[known[bounds[i] : bounds[i + 1]]] = own[at[bounds[i] : bounds[i + 1]] - starts[i]]
        return out


@lru_cache(maxsize=4096)
def _mapped(folder: str, name: str, kind: str) -> np.ndarray:
    return map_array(folder, name, kind)


def _in_order(manifest: DataFrame, n: int, folder: str) -> Ranges:
    """A row per range comes to the driver: its file and its size."""
    found = {r["shard"]: (r["file"], r["n"]) for r in manifest.select("shard", "file", "n").collect()}
    return Ranges(folder, tuple(found.get(i, ("", 0)) for i in range(n)))


@dataclass(frozen=True)
class Model:
    words: Ranges
    stats: Ranges  # the files of per-word arrays; same order and sizes as ``words``, and the start of a text behind them
    pairs: Ranges
    n_tokens: int
    discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    n_pairs: int
    word_backoff: float

    @property
    def n_words(self) -> int:
        return int(self.words.starts[-1])


def _discounts(n: list[int]) -> tuple[float, float, float]:
    """Of counts one, two, and three or more, from how many entries have the counts one to four."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    found = [k + 1 - (k + 2) * y * n[k + 1] / n[k] if n[k] else 0.0 for k in range(3)]
    return tuple(min(max(d, 0.0), k + 1.0) for k, d in enumerate(found))


def _discount(counts: np.ndarray, discounts: tuple[float, float, float]) -> np.ndarray:
    return np.array([0.0, *discounts])[np.minimum(counts, 3)]


def _count_words(docs: DataFrame, text: str, n: int, folder: str) -> DataFrame:
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []

        def flush():
            keys, counts = np.unique(np.concatenate(waiting), return_counts=True)
            waiting.clear()
            bounds = np.searchsorted(_range_of(keys, n), np.arange(n + 1, dtype=np.uint64))
            return _pieces(keys, [counts.astype("<u4")], bounds)

        for batch in batches:
            for piece in slices(batch.column(0)):
                waiting.append(tokens_of(piece)[0])
                if sum(map(len, waiting)) >= BLOCK_TOKENS:
                    yield flush()
        if waiting:
            yield flush()

    def merge(group: pa.Table) -> pa.Table:
        shard = group.column("shard")[0].as_py()
        keys, counts = _added_up(_joined(group, "v0", "<u8"), _joined(group, "v1", "<u4"))
        name = _name("words", shard)
        write_array(folder, f"{name}.key", keys)
        write_array(folder, f"{name}.cnt", counts.astype("<i8"))
        return pa.table({"shard": pa.array([shard], pa.int32()), "file": [name], "n": [len(keys)], "tokens": [int(counts.sum())]})

    emitted = docs.select(text).mapInArrow(emit, "shard int, v0 binary, v1 binary")
    return materialize(
        emitted.groupBy("shard").applyInArrow(merge, "shard int, file string, n long, tokens long"), "language-model-words"
    )


def _numbers(words: Ranges, tokens: np.ndarray) -> np.ndarray:
    distinct, back = np.unique(tokens, return_inverse=True)
    return words.find(distinct)[back]


def _count_pairs(docs: DataFrame, text: str, words: Ranges, n: int, folder: str) -> DataFrame:
    """Write the pairs; a row per range, and rows of partial sums per word (``kind`` 0: as context, 1: as word)."""
    n_words = int(words.starts[-1])
    size = -(-(n_words + 1) // n)  # words per range of numbers, with the start of a text

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[np.ndarray, np.ndarray]] = []

        def flush():
            tokens = np.concatenate([t for t, _ in waiting])
            shift = np.cumsum([0] + [len(t) for t, _ in waiting])
            first = np.concatenate([f + s for (_, f), s in zip(waiting, shift)])
            waiting.clear()
            number = _numbers(words, tokens).astype(np.uint64)
            before = np.empty_like(number)
            before[1:] = number[:-1]
            before[first] = n_words
            keys, counts = np.unique(mix((before << _U32) | number), return_counts=True)
            bounds = np.searchsorted(_range_of(keys, n), np.arange(n + 1, dtype=np.uint64))
            return _pieces(keys, [counts.astype("<u4")], bounds)

        for batch in batches:
            for piece in slices(batch.column(0)):
                tokens, _, first = tokens_of(piece)
                waiting.append((tokens, first))
                if sum(len(t) for t, _ in waiting) >= BLOCK_TOKENS:
                    yield flush()
        if waiting:
            yield flush()

    def merge(group: pa.Table) -> pa.Table:
        shard = group.column("shard")[0].as_py()
        keys, counts = _added_up(_joined(group, "v0", "<u8"), _joined(group, "v1", "<u4"))
        name = _name("pairs", shard)
        write_array(folder, f"{name}.key", keys)
        write_array(folder, f"{name}.cnt", counts.astype("<u4"))
        raw = _unmix(keys)
        rows = {c: [] for c in ("kind", "shard", "file", "n", "v0", "v1", "counts")}

        def add(kind, shard, file, n, v0, v1, of_counts):
            for column, value in zip(rows.values(), (kind, shard, file, n, v0, v1, of_counts)):
                column.append(value)

        of_counts = np.bincount(np.minimum(counts, 5), minlength=6)[1:5].tolist()
        add(-1, shard, name, len(keys), b"", b"", of_counts)
        before, after = (raw >> _U32).astype(np.int64), (raw & np.uint64(0xFFFFFFFF)).astype(np.int64)
        for kind, number in ((0, before), (1, after)):
            order = np.argsort(number, kind="stable")
            number, c = number[order], counts[order]
            new = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]]))
            sums = [np.add.reduceat(c == 1, new, dtype=np.int64), np.add.reduceat(c == 2, new, dtype=np.int64)]
            sums = [np.add.reduceat(c, new), *sums, np.add.reduceat(c > 2, new, dtype=np.int64)] if kind == 0 else [
                np.diff(np.append(new, len(number)))
            ]
            number = number[new]
            bounds = np.searchsorted(number, np.arange(n + 1) * size)
            for i in np.flatnonzero(np.diff(bounds)).tolist():
                cut = slice(bounds[i], bounds[i + 1])
                values = np.stack([s[cut] for s in sums]).astype("<u8" if kind == 0 else "<u4")
                add(kind, i, None, None, number[cut].astype("<u4").tobytes(), values.tobytes(), None)
        kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
        return pa.table({c: pa.array(v, t) for (c, v), t in zip(rows.items(), kinds)})

    emitted = docs.select(text).mapInArrow(emit, "shard int, v0 binary, v1 binary")
    schema = "kind int, shard int, file string, n long, v0 binary, v1 binary, counts array<long>"
    return materialize(emitted.groupBy("shard").applyInArrow(merge, schema), "language-model-pairs")


def _word_stats(partial: DataFrame, n_words: int, n: int, discounts: tuple[float, float, float], folder: str) -> DataFrame:
    size = -(-(n_words + 1) // n)

    def merge(group: pa.Table) -> pa.Table:
        shard = group.column("shard")[0].as_py()
        own = min(size, n_words + 1 - shard * size)
        total, seen = np.zeros((4, own), dtype=np.int64), np.zeros(own, dtype=np.int64)
        for kind, number, values in zip(*(group.column(c) for c in ("kind", "v0", "v1"))):
            at = np.frombuffer(number.as_buffer(), dtype="<u4").astype(np.int64) - shard * size  # distinct within a row
            if kind.as_py() == 0:
                total[:, at] += np.frombuffer(values.as_buffer(), dtype="<u8").reshape(4, -1).astype(np.int64)
            else:
                seen[at] += np.frombuffer(values.as_buffer(), dtype="<u4")
        weight = discounts[0] * total[1] + discounts[1] * total[2] + discounts[2] * total[3]
        name = _name("stats", shard)
        write_array(folder, f"{name}.total", total[0].astype("<i8"))
        write_array(folder, f"{name}.backoff", (weight / np.maximum(total[0], 1)).astype("<f4"))
        write_array(folder, f"{name}.before", seen.astype("<u4"))
        of_counts = np.bincount(np.minimum(seen, 5), minlength=6)[1:5].tolist()
        more = int((seen > 2).sum())
        kinds = {"shard": pa.int32(), "file": pa.string(), "n": pa.int64(), "counts": pa.list_(pa.int64()), "more": pa.int64()}
        row = (shard, name, own, of_counts, more)
        return pa.table({c: pa.array([v], t) for (c, t), v in zip(kinds.items(), row)})

    sums = partial.where("kind >= 0").select("shard", "kind", "v0", "v1")
    schema = "shard int, file string, n long, counts array<long>, more long"
    return materialize(sums.groupBy("shard").applyInArrow(merge, schema), "language-model-stats")


def _sum_counts(rows: DataFrame) -> list[int]:
    return [x or 0 for x in rows.agg(*(F.sum(F.col("counts")[k]) for k in range(4))).first()]


def train(docs: DataFrame, text: str = "text") -> Model:
    """Count ``docs`` and write the model to the shared folder."""
    folder = f"{shared_folder(docs.sparkSession)}/casegraph-model-{uuid.uuid4().hex}"
    n_bytes = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n = int(n_bytes // SHARD_BYTES + 1)
    counted = _count_words(docs, text, n, folder)
    words = _in_order(counted, n, folder)
    n_words = int(words.starts[-1])
    if n_words >= (1 << 32) - 1:
        raise ValueError("more than four billion different words: number them with more than 32 bits")
    n_tokens = counted.agg(F.sum("tokens")).first()[0] or 0
    found = _count_pairs(docs, text, words, n, folder)
    ranges = found.where("kind = -1")
    pairs = _in_order(ranges, n, folder)
    discounts = _discounts(_sum_counts(ranges))
    stats_rows = _word_stats(found, n_words, n, discounts, folder)
    stats = _in_order(stats_rows, n, folder)
    of_words = _sum_counts(stats_rows)
    word_discounts = _discounts(of_words)
    n_pairs = int(pairs.starts[-1])
    more = stats_rows.agg(F.sum("more")).first()[0] or 0
    weight = word_discounts[0] * of_words[0] + word_discounts[1] * of_words[1] + word_discounts[2] * more
    return Model(words, stats, pairs, n_tokens, discounts, word_discounts, n_pairs, weight / n_pairs if n_pairs else 1.0)


def _score_block(model: Model, tokens: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """log10 probabilities of the tokens by the base and by the model, and whether each is known."""
    v = model.n_words
    distinct, back = np.unique(tokens, return_inverse=True)
    place = model.words.find(distinct)
    count = model.words.take("cnt", "<i8", place)
    base = np.log10((count + 1.0) / (model.n_tokens + 1.0 * (v + 1)))
    seen = model.stats.take("before", "<u4", place).astype(np.int64)
    word = np.maximum(seen - _discount(seen, model.word_discounts), 0) / max(model.n_pairs, 1)
    word += model.word_backoff / (v + 1)
    # as contexts: the words and the start of a text behind them
    place = np.append(place, v)
    total = model.stats.take("total", "<i8", place)
    backoff = model.stats.take("backoff", "<f4", place).astype(np.float64)
    before = np.empty(len(back), dtype=np.int64)
    before[1:] = back[:-1]
    before[first] = len(distinct)
    keys = mix((place[before].astype(np.uint64) << _U32) | (place[back] & 0xFFFFFFFF).astype(np.uint64))
    keys, where = np.unique(keys, return_inverse=True)
    pair = model.pairs.take("cnt", "<u4", model.pairs.find(keys))[where].astype(np.int64)
    pair[(place[before] < 0) | (place[back] < 0)] = 0
    context = total[before]
    higher = np.maximum(pair - _discount(pair, model.discounts), 0) / np.maximum(context, 1)
    probability = np.where(context > 0, higher + backoff[before] * word[back], word[back])
    return base[back], np.log10(probability), count[back] > 0


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``n_tokens, n_known, train_tokens, base_score, score`` and the model's ``perplexity``."""
    fields = "n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"
    names = [f.split()[0] for f in fields.split(", ")]
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in names]
    docs = docs.select(*dict.fromkeys([*kept, text]))
    schema = docs.select(*kept).schema
    for field in fields.split(", "):
        schema = schema.add(*field.split())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [np.zeros(batch.num_rows) for _ in range(4)]
            waiting: list[tuple[Slice, np.ndarray, np.ndarray, np.ndarray]] = []

            def flush():
                shift = np.cumsum([0] + [len(w[1]) for w in waiting])
                tokens = np.concatenate([w[1] for w in waiting])
                row = np.concatenate([w[2] + w[0].first for w in waiting])
                first = np.concatenate([w[3] + s for w, s in zip(waiting, shift)])
                waiting.clear()
                base, own, known = _score_block(model, tokens, first)
                for total, values in zip(sums, (np.ones(len(row)), known, base, own)):
                    total += np.bincount(row, weights=values, minlength=batch.num_rows)

            for piece in slices(batch.column(batch.schema.get_field_index(text))):
                waiting.append((piece, *tokens_of(piece)))
                if sum(len(w[1]) for w in waiting) >= SCORE_TOKENS:
                    flush()
            if waiting:
                flush()
            n, known, base, own = sums
            made = [n.astype(np.int64), known.astype(np.int64), np.full(len(n), model.n_tokens), base, own, 10 ** (-own / np.maximum(n, 1))]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(m) for m in made)], names=schema.names)

    return docs.mapInArrow(run, schema)
