"""Mentions of symptoms, diseases and medications in note text, and entity lists per case."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casegraph.functions import text as tx
from casegraph.operators.automaton import build
from casegraph.operators.cohort import drop_missing, restrict_wide
from casegraph.session import fits

KINDS = ("symptom", "disease", "medication")
LIST_OF_KIND = {"symptom": "symptoms", "disease": "diseases", "medication": "medications"}

# A dictionary beyond this size is joined by shuffle instead of broadcast.
MAX_BROADCAST_TERMS = 1_000_000
MAX_BROADCAST_TOKENS = 5_000_000
# Tokens that a task works on together, so that its memory does not follow the size of its batches.
TOKENS_AT_ONCE = 200_000


def select_notes(notes: DataFrame, cases: DataFrame, id_col: str = "hadm_id", text_col: str = "text") -> DataFrame:
    """Notes with text that belong to known cases."""
    return restrict_wide(drop_missing(notes, [id_col, text_col]), cases, id_col, text_col)


def pending_notes(notes: DataFrame, done: DataFrame, id_col: str = "hadm_id", text_col: str = "text") -> DataFrame:
    """Notes of cases without a stored result."""
    return restrict_wide(notes, done, id_col, text_col, "left_anti")


def _terms(dictionary: DataFrame) -> DataFrame:
    """Different ``words, kind`` of the terms that have a token."""
    return dictionary.select(tx.tokens(F.col("term")).alias("words"), "kind").where(F.size("words") > 0).distinct()


def dictionary_mentions(
    notes: DataFrame, dictionary: DataFrame, id_col: str = "hadm_id", text_col: str = "text"
) -> DataFrame:
    """Occurrences of the ``(term, kind)`` rows of ``dictionary`` in the whole text of each note.

    Result: id, term, kind and ``n`` occurrences. A term is a run of tokens of any length; overlapping occurrences all
    count. An automaton reads each note once, in the stage that produces the tokens; only matches, already counted per
    batch, are shuffled. A dictionary too large to be sent to every task (a checked size) is joined instead.
    """
    terms = _terms(dictionary)
    size = terms.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("words")).alias("tokens")).first()
    if size["n"] > MAX_BROADCAST_TERMS or (size["tokens"] or 0) > MAX_BROADCAST_TOKENS:
        return joined_mentions(notes, dictionary, id_col, text_col)
    kinds: dict[tuple[str, ...], list[str]] = {}
    for row in terms.collect():
        kinds.setdefault(tuple(row["words"]), []).append(row["kind"])
    found = _automaton_counts(notes.select(F.col(id_col).alias("id"), tx.tokens(F.col(text_col)).alias("tokens")), kinds)
    return found.withColumnRenamed("id", id_col).groupBy(id_col, "term", "kind").agg(F.sum("n").alias("n"))


def _automaton_counts(tokens: DataFrame, kinds: dict[tuple[str, ...], list[str]]) -> DataFrame:
    """``id, term, kind, n`` of the notes ``id, tokens``, counted per note and batch."""
    words = sorted(kinds)
    # a term once for each of its kinds
    rows = [(" ".join(w), kind) for w in words for kind in kinds[w]]
    per_term = np.array([len(kinds[w]) for w in words], dtype=np.int64)
    sent = tokens.sparkSession.sparkContext.broadcast((build(words), rows, per_term))
    schema = f"id {tokens.schema['id'].dataType.simpleString()}, term string, kind string, n bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, named, repeats = sent.value
        names, groups = (pa.array([r[i] for r in named], type=pa.string()) for i in (0, 1))
        first = np.cumsum(repeats) - repeats
        for batch in batches:
            lists = batch.column(1)
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            numbers = automaton.number(lists.flatten())
            ends = np.append(0, np.cumsum(sizes))
            for start, stop in _parts(ends, TOKENS_AT_ONCE):
                note = np.repeat(np.arange(start, stop), sizes[start:stop])
                note, term = automaton.find(numbers[ends[start] : ends[stop]], note)
                pairs, n = np.unique(note * max(len(repeats), 1) + term, return_counts=True)
                note, term = pairs // max(len(repeats), 1), pairs % max(len(repeats), 1)
                times = repeats[term]
                row = np.repeat(first[term], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                columns = [batch.column(0).take(pa.array(np.repeat(note, times))), names.take(pa.array(row)), groups.take(pa.array(row))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(np.repeat(n, times))], names=["id", "term", "kind", "n"])

    return tokens.mapInArrow(run, schema)


def _parts(ends: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of notes with at most ``size`` tokens, or one note with more; ``ends`` counts tokens before each note, and all."""
    start, n = 0, len(ends) - 1
    while start < n:
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + size, side="right")) - 1)
        yield start, stop
        start = stop


def joined_mentions(
    notes: DataFrame, dictionary: DataFrame, id_col: str = "hadm_id", text_col: str = "text"
) -> DataFrame:
    """As ``dictionary_mentions``, for dictionaries of any size: runs of all lengths that the dictionary has are looked up
    as whole terms, by a join."""
    words = tx.tokens(F.col("term"))
    terms = dictionary.select(F.array_join(words, " ").alias("term"), F.size(words).alias("_size"), "kind")
    terms = terms.where(F.col("_size") > 0).distinct()
    lengths = sorted(r["_size"] for r in terms.select("_size").distinct().collect())
    if not lengths:
        return notes.join(terms, F.lit(False)).groupBy(id_col, "term", "kind").agg(F.count(F.lit(1)).alias("n"))
    terms = terms.drop("_size")
    if fits(terms, MAX_BROADCAST_TERMS):
        terms = F.broadcast(terms)
    # A plain explode or inline would make the optimizer test the size of the list below the
    # tokenisation, which repeats it; the null row of the outer form finds no partner in the join.
    places = [f"w{i}" for i in range(1, lengths[-1] + 1)]
    runs = notes.select(id_col, tx.tokens(F.col(text_col)).alias("_tokens")).select(
        id_col, F.inline_outer(tx.token_runs(F.col("_tokens"), lengths[-1])).alias(*places)
    )
    # a run past the end of the text has a null and is no term
    whole = [F.concat(*[x for p in places[:n] for x in (F.lit(" "), F.col(p))][1:]) for n in lengths]
    runs = runs.select(id_col, F.explode(F.array(*whole)).alias("term"))
    return runs.join(terms, "term").groupBy(id_col, "term", "kind").agg(F.count(F.lit(1)).alias("n"))


def resolve_label(labels: DataFrame, column: str, candidates: Sequence[str] = tuple(tx.MEDICATION_LABELS)) -> DataFrame:
    """One row: the first of ``candidates`` that occurs in ``column``, without its tag prefix (null if none does)."""
    place = F.array_position(F.lit(list(candidates)), F.col(column))
    best = F.min(F.when(place > 0, place))
    return labels.agg(tx.strip_tag(F.get(F.lit(list(candidates)), (best - 1).cast("int"))).alias("label"))


def label_kinds(medication_label: str | None = "Medication") -> dict[str, str]:
    """Tag group -> kind."""
    kinds = {tx.SYMPTOM_LABEL: "symptom", tx.DISEASE_LABEL: "disease"}
    if medication_label:
        kinds.setdefault(medication_label, "medication")
    return kinds


def route_mentions(mentions: DataFrame, group_col: str, kinds: dict[str, str]) -> DataFrame:
    """Add ``kind`` by tag group; mentions of other groups are dropped."""
    kind = F.lit(None).cast("string")
    for group, name in kinds.items():
        kind = F.when(F.col(group_col) == group, F.lit(name)).otherwise(kind)
    return mentions.withColumn("kind", kind).where(F.col("kind").isNotNull())


Extractor = Callable[[list[str]], list[list[dict]]]


def model_mentions(
    notes: DataFrame,
    load: Callable[[], Extractor],
    id_col: str = "hadm_id",
    text_col: str = "text",
    window_words: int | None = None,
    batch_size: int = 64,
) -> DataFrame:
    """Mentions found by a user-supplied model.

    ``load`` runs once per task and returns a function from a batch of texts to one list of
    ``{"entity_group", "word"}`` per text. Result: one row per note with ``mentions``, or with
    ``error`` if the model failed on that note; a failing batch is retried note by note, so
    one bad note does not take its neighbours along. ``window_words`` cuts each text for
    models with a limited input length; by default they get the whole text.
    """
    text = tx.first_words(F.col(text_col), window_words) if window_words else F.col(text_col)
    # a blank note has no mentions; the model does not get to see it
    prepared = notes.select(F.col(id_col).alias("id"), F.when(~tx.is_blank(text), text).alias("text"))

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        extract = load()

        def one(text_value: str):
            try:
                return extract([text_value])[0], None
            except Exception as exc:  # a model may raise anything; the note carries the message
                return [], f"{type(exc).__name__}: {exc}"

        for frame in batches:
            blank = frame[frame["text"].isna()]
            if len(blank):
                nothing = [[] for _ in range(len(blank))]
                yield pd.DataFrame({"id": blank["id"].to_numpy(), "mentions": nothing, "error": pd.Series([None] * len(blank), dtype="object")})
            frame = frame[frame["text"].notna()]
            for start in range(0, len(frame), batch_size):
                part = frame.iloc[start : start + batch_size]
                texts = part["text"].tolist()
                try:
                    found = [(entities, None) for entities in extract(texts)]
                    if len(found) != len(texts):
                        raise ValueError("the model returned a list of another length")
                except Exception:
                    found = [one(t) for t in texts]
                yield pd.DataFrame(
                    {
                        "id": part["id"].to_numpy(),
                        "mentions": [
                            [{"entity_group": e["entity_group"], "word": e["word"]} for e in entities]
                            for entities, _ in found
                        ],
                        "error": pd.Series([error for _, error in found], dtype="object"),
                    }
                )

    id_type = notes.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, mentions array<struct<entity_group: string, word: string>>, error string"
    return prepared.mapInPandas(run, schema).withColumnRenamed("id", id_col)


def mention_rows(extracted: DataFrame, kinds: dict[str, str], id_col: str = "hadm_id") -> DataFrame:
    """``model_mentions`` output as (id, term, kind) rows."""
    rows = extracted.select(id_col, F.inline("mentions"))
    rows = rows.withColumn("term", tx.normalize_mention(F.col("word")))
    return route_mentions(rows, "entity_group", kinds).select(id_col, "term", "kind")


def entity_sets(mentions: DataFrame, id_col: str = "hadm_id") -> DataFrame:
    """Per case the sorted sets of its symptom, disease and medication terms, over all its notes."""
    collected = [
        F.array_sort(F.collect_set(F.when(F.col("kind") == kind, F.col("term")))).alias(LIST_OF_KIND[kind])
        for kind in KINDS
    ]
    return mentions.groupBy(id_col).agg(*collected)


def complete_entity_sets(sets: DataFrame, processed: DataFrame, id_col: str = "hadm_id") -> DataFrame:
    """Cases that were processed but have no mention get empty lists."""
    empty = F.array().cast("array<string>")
    return (
        processed.select(id_col).distinct().join(sets, id_col, "left")
        .select(id_col, *[F.coalesce(F.col(c), empty).alias(c) for c in LIST_OF_KIND.values()])
    )


def union_entity_sets(sets: DataFrame, id_col: str = "hadm_id") -> DataFrame:
    """One row per case: the union of its lists over all rows. Repeating a row changes nothing.

    Lists are taken apart first, so a case with very many rows is reduced to its distinct
    terms before the shuffle.
    """
    parts = [
        sets.select(id_col, F.explode_outer(c).alias("term")).withColumn("kind", F.lit(kind))
        for kind, c in LIST_OF_KIND.items()
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return entity_sets(rows, id_col)


def merge_entity_sets(left: DataFrame, right: DataFrame, id_col: str = "hadm_id") -> DataFrame:
    """Union of two entity tables, case by case and list by list."""
    columns = [id_col, *LIST_OF_KIND.values()]
    return union_entity_sets(left.select(*columns).unionByName(right.select(*columns)), id_col)


def clean_entity_sets(sets: DataFrame) -> DataFrame:
    """Entity lists without sub-word debris, very short and generic mentions."""
    return sets.withColumns({c: tx.clean_mentions(F.col(c)) for c in LIST_OF_KIND.values()})


def entity_counts(sets: DataFrame, id_col: str = "hadm_id", cleaned: bool = True) -> DataFrame:
    """List lengths per case; of the cleaned lists by default, which are the ones the graph shows."""
    source = clean_entity_sets(sets) if cleaned else sets
    return source.select(
        id_col, *[F.size(c).cast("bigint").alias(f"n_nlp_{c}") for c in LIST_OF_KIND.values()]
    )


def extraction_report(extracted: DataFrame, notes: DataFrame, done: DataFrame | None, id_col: str = "hadm_id") -> DataFrame:
    """Counters of an extraction run as (metric, value) rows: processed, skipped, failed, enriched."""
    spark_skipped = (
        notes.join(done.select(id_col).distinct(), id_col, "left_semi") if done is not None else notes.limit(0)
    )
    failed = F.col("error").isNotNull()
    run = extracted.agg(
        F.count(F.lit(1)).alias("processed"),
        F.count(F.when(failed, 1)).alias("failed"),
        F.count_distinct(F.when(~failed, F.col(id_col))).alias("enriched"),
    )
    skipped = spark_skipped.agg(F.count(F.lit(1)).alias("skipped"))
    return _long(run, ["processed", "failed", "enriched"]).unionByName(_long(skipped, ["skipped"]))


def _long(row: DataFrame, names: Sequence[str]) -> DataFrame:
    cells: list[Column] = [F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names]
    return row.select(F.inline(F.array(*cells)))
