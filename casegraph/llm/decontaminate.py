"""Benchmark decontamination with an FM-index per training shard.

Documents are read in shards, the slices of a task's input. A shard's words are numbered by the words that occur in
benchmark phrases; all other words separate runs, since no phrase can contain them. The runs are indexed, every
phrase is searched backwards in the index, its occurrences are located by sampled positions, and the words they
cover are merged to removal spans. Phrases are windows of ``window`` words of an item; a shorter item is one phrase.

The benchmark is the query set: its phrases go to every task in blocks of at most ``block_bytes`` of text, one
block after the other, whatever its size; documents are read once and never shuffled.

* null or empty text, in documents or items: no words; an item without words has no phrases;
* repeated items (same id): one item with the phrases of all its rows; a null item id is an item too;
* repeated documents: each row gets its own result; no documents or no items: no rows, or no hits;
* columns named like a result are replaced, others pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, StructField, StructType

from casegraph.llm.columns import set_aside
from casegraph.llm.fm_index import FMIndex
from casegraph.llm.words import LETTERS_DIGITS, LOWER, Slice, Words, find_words, hash_runs, slices

SHARD_SYMBOLS = 1 << 20


@dataclass
class Phrases:
    """Distinct phrases by length, over a vocabulary of word hashes; ``items`` of each phrase as offsets and values."""

    vocabulary: np.ndarray
    by_length: list[tuple[np.ndarray, np.ndarray, np.ndarray]]

    @property
    def shortest(self) -> int:
        return min((p.shape[1] for p, _, _ in self.by_length), default=1)


def phrases_of(items: list[tuple[int, str | None]], window: int) -> Phrases:
    """``items`` are (number, text)."""
    hashed = []
    for piece in slices(pa.array([text for _, text in items], pa.string())):
        data = LOWER[piece.data]
        words = find_words(piece, LETTERS_DIGITS, data)
        hashes = hash_runs(data, words.start, words.end)
        cuts = np.searchsorted(words.text, np.arange(1, piece.n))
        hashed += list(zip([n for n, _ in items[piece.first : piece.first + piece.n]], np.split(hashes, cuts)))
    hashed = [(n, h) for n, h in hashed if len(h)]
    if not hashed:
        return Phrases(np.zeros(0, dtype=np.uint64), [])
    vocabulary = np.unique(np.concatenate([h for _, h in hashed]))
    rows: dict[int, list[tuple[np.ndarray, int]]] = {}
    for number, h in hashed:
        symbols = np.searchsorted(vocabulary, h) + 1
        size = min(window, len(symbols))
        windows = np.lib.stride_tricks.sliding_window_view(symbols, size)
        rows.setdefault(size, []).append((windows, number))
    by_length = []
    for found in rows.values():
        patterns, of = np.unique(np.concatenate([w for w, _ in found]), axis=0, return_inverse=True)
        pairs = np.unique(np.stack([of.reshape(-1), np.repeat([n for _, n in found], [len(w) for w, _ in found])]), axis=1)
        offsets = np.searchsorted(pairs[0], np.arange(len(patterns) + 1))
        by_length.append((patterns, offsets, pairs[1]))
    return Phrases(vocabulary, by_length)


@dataclass
class _Part:
    """The words of one slice that can be part of an occurrence."""

    piece: Slice
    words: Words
    symbols: np.ndarray
    places: np.ndarray  # the word at each symbol, -1 at separators


def _reduce(piece: Slice, phrases: Phrases) -> _Part:
    data = LOWER[piece.data]
    words = find_words(piece, LETTERS_DIGITS, data)
    hashes = hash_runs(data, words.start, words.end)
    at = np.searchsorted(phrases.vocabulary, hashes)
    symbols = np.where(np.append(phrases.vocabulary, np.uint64(0))[at] == hashes, at + 1, 0)
    symbols[at == len(phrases.vocabulary)] = 0
    inside = np.flatnonzero(symbols)
    if not len(inside):
        return _Part(piece, words, np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))
    begins = np.ones(len(inside), dtype=bool)
    begins[1:] = (np.diff(inside) > 1) | (np.diff(words.text[inside]) > 0)
    run = np.cumsum(begins) - 1
    long_enough = np.bincount(run) >= phrases.shortest
    inside, begins = inside[long_enough[run]], begins[long_enough[run]]
    # a separator before each run
    place = np.arange(len(inside)) + np.cumsum(begins)
    out = np.zeros(len(inside) + int(begins.sum()), dtype=np.int64)
    places = np.full(len(out), -1, dtype=np.int64)
    out[place], places[place] = symbols[inside], inside
    return _Part(piece, words, out, places)


def _occurrences(parts: list[_Part], phrases: Phrases) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """Start symbols of occurrences, their length, and the item of each."""
    symbols = np.concatenate([*(p.symbols for p in parts), [0]])
    if len(symbols) < 2:
        return
    index = FMIndex(symbols, len(phrases.vocabulary))
    for patterns, offsets, items in phrases.by_length:
        low, high = index.search(patterns)
        found = np.flatnonzero(low < high)
        for at in range(0, len(found), 4096):
            some = found[at : at + 4096]
            count = high[some] - low[some]
            pattern = np.repeat(some, count)
            rows = np.repeat(low[some] - (np.cumsum(count) - count), count) + np.arange(len(pattern))
            start = index.locate(rows)
            n_items = offsets[pattern + 1] - offsets[pattern]
            each = np.repeat(np.arange(len(pattern)), n_items)
            nth = np.arange(len(each)) - np.repeat(np.cumsum(n_items) - n_items, n_items)
            yield start[each], patterns.shape[1], items[offsets[pattern[each]] + nth]


def _search(parts: list[_Part], phrases: Phrases, hits: list[np.ndarray], items: list[set]) -> None:
    """Mark the words that occurrences cover, per slice, and add the items found to each text's set."""
    bounds = np.cumsum([0] + [len(p.symbols) for p in parts])
    edges = [np.zeros(len(p.words.start) + 1, dtype=np.int64) for p in parts]
    for start, length, item in _occurrences(parts, phrases):
        of = np.searchsorted(bounds, start, side="right") - 1
        for k in np.unique(of).tolist():
            part, mine = parts[k], of == k
            word = part.places[start[mine] - bounds[k]]
            np.add.at(edges[k], word, 1)
            np.add.at(edges[k], word + length, -1)
            pairs = np.unique(np.stack([part.words.text[word] + part.piece.first, item[mine]]), axis=1)
            for text, number in pairs.T.tolist():
                items[text].add(number)
    hits += [np.cumsum(e[:-1]) > 0 for e in edges]


def _runs(covered: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last word of each maximal run of covered words of one text."""
    at = np.flatnonzero(covered)
    if not len(at):
        return at, at
    apart = (np.diff(at) > 1) | (np.diff(text[at]) > 0)
    return at[np.concatenate([[True], apart])], at[np.concatenate([apart, [True]])]


_STATE = "n_words long, n_hit long, hit_from array<long>, hit_to array<long>, byte_from array<long>, byte_to array<long>"


def _annotate(
    column: pa.Array, phrases: Phrases, ids: list, item_type: pa.DataType, earlier: dict[str, list] | None
) -> list[pa.Array]:
    n = len(column)
    items: list[set] = [set() for _ in range(n)]
    n_words, n_hit = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    lists: list[list[np.ndarray]] = [[], [], [], []]
    sizes = []

    def finish(parts: list[_Part]) -> None:
        hits: list[np.ndarray] = []
        _search(parts, phrases, hits, items)
        for part, covered in zip(parts, hits):
            own = slice(part.piece.first, part.piece.first + part.piece.n)
            counts = part.words.counts(part.piece.n)
            first_word = np.cumsum(counts) - counts
            if earlier:
                for i, (a, b) in enumerate(zip(earlier["hit_from"][own], earlier["hit_to"][own])):
                    for x, y in zip(a, b):
                        covered[first_word[i] + x : first_word[i] + y] = True
            a, b = _runs(covered, part.words.text)
            text = part.words.text[a]
            n_words[own] = counts
            n_hit[own] = np.bincount(part.words.text[covered], minlength=part.piece.n)
            begin = part.piece.offsets[text]
            values = (a - first_word[text], b + 1 - first_word[text], part.words.start[a] - begin, part.words.end[b] - begin)
            for kept, v in zip(lists, values):
                kept.append(v)
            sizes.append(np.bincount(text, minlength=part.piece.n))

    waiting: list[_Part] = []
    size = 0
    for piece in slices(column):
        waiting.append(_reduce(piece, phrases))
        size += len(waiting[-1].symbols)
        if size >= SHARD_SYMBOLS:
            finish(waiting)
            waiting, size = [], 0
    if waiting:
        finish(waiting)
    offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]) if sizes else np.zeros(1)
    offsets = pa.array(offsets, pa.int32())
    spans = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(v) if v else [], pa.int64())) for v in lists]
    named = [{ids[i]: None for i in sorted(x)} for x in items]
    if earlier:
        named = [dict.fromkeys(old) | new for old, new in zip(earlier["items"], named)]
    return [pa.array(n_words), pa.array(n_hit), *spans, pa.array([list(x) for x in named], pa.list_(item_type))]


def mark_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    keep: list[str] | None = None,
    block_bytes: int = 16 << 20,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``items`` (ids of items with occurring phrases) and ``spans``: the merged
    stretches of hit words, as byte ranges of the UTF-8 text."""
    item_type = benchmark.schema[item_id].dataType
    state = StructType([*StructType.fromDDL(_STATE), StructField("items", ArrayType(item_type))])
    names = {f.name for f in state} | {"spans"}
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in names]
    out = docs.select(*dict.fromkeys([*kept, text]))
    found = benchmark.select(F.col(item_id).alias("id"), F.col(item_text).alias("text"))
    blocks = (found.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes + 1
    for b in range(blocks):
        mine = found.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b).collect()  # about block_bytes of text
        ids = list(dict.fromkeys(r["id"] for r in mine))
        number = {id: n for n, id in enumerate(ids)}
        phrases = phrases_of([(number[r["id"]], r["text"]) for r in mine], window)
        out = _apply(out, phrases, ids, text, state, later=b > 0)
    spans = F.transform(
        F.arrays_zip("byte_from", "byte_to"), lambda x: F.struct(x["byte_from"].alias("begin"), x["byte_to"].alias("end"))
    )
    return out.withColumn("spans", spans).select(*kept, "n_words", "n_hit", "items", "spans")


def _apply(docs: DataFrame, phrases: Phrases, ids: list, text: str, state: StructType, later: bool) -> DataFrame:
    """One block of phrases; a later block adds to what the earlier ones found."""
    carried = [c for c in docs.columns if c not in set(state.names)]
    schema = StructType([docs.schema[c] for c in carried] + list(state))
    item_type = to_arrow_schema(state)[-1].type.value_type
    shared = docs.sparkSession.sparkContext.broadcast((phrases, ids))  # one block, of bounded size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases, ids = shared.value
        for batch in batches:
            column = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
            earlier = {c: column[c].to_pylist() for c in ("hit_from", "hit_to", "items")} if later else None
            made = _annotate(column[text], phrases, ids, item_type, earlier)
            yield pa.RecordBatch.from_arrays([*(column[c] for c in carried), *made], names=schema.names)

    return docs.mapInArrow(run, schema)


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` without the hit stretches of their texts; all rows and columns stay."""
    aside, restore = set_aside(docs, [f.name for f in StructType.fromDDL(_STATE)] + ["items", "spans"])
    marked = mark_contamination(aside, benchmark, text, **options)
    bytes_ = F.encode(text, "UTF-8")
    # what lies before each stretch, and the rest behind the last
    begins = F.concat(F.array(F.lit(0).cast("long")), F.transform("spans", lambda s: s["end"]))
    ends = F.concat(F.transform("spans", lambda s: s["begin"]), F.array(F.octet_length(text).cast("long")))
    pieces = F.transform(
        F.arrays_zip(begins.alias("a"), ends.alias("b")),
        lambda p: F.decode(F.substring(bytes_, (p["a"] + 1).cast("int"), (p["b"] - p["a"]).cast("int")), "UTF-8"),
    )
    cut = F.when(F.size("spans") > 0, F.array_join(pieces, "")).otherwise(F.col(text))
    return restore(marked.withColumn(text, cut))
