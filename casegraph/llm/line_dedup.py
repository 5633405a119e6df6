"""Near-duplicate lines by a segment-partition edit join, in DataFrame functions only.

A line is compared without case and outer spaces; blank lines stay. A line of which an equal one, or one within the allowed
edits, stands earlier (by document id, text hash, line number) is removed; the earliest stays. The allowance grows with
the length of the shorter line: one edit per ``chars_per_edit`` characters, up to ``edits``, so very short lines must be
equal. Lines are few distinct texts, so equal ones are grouped by a 128-bit hash before anything else.

Edits: with ``e`` allowed, a line is split into ``e + 1`` even segments. Of two lines within so many edits, one segment of
the shorter stands unchanged in the longer, at one of a few places that follow from the lengths. So every line is
indexed under its segments (hash of length, number and text) and probes the segments of all lengths up to ``e`` shorter
at these places. Segments that no other line has go first. Then each line is compared with the first line that has one of
its segments; a line near that one is settled, so many lines near each other make a pair each and not all pairs. Only
the others are joined with all earlier lines that share a segment. Before a pair is passed on, counts of common letters
are compared, which few edits can change by little only; so lines that share a segment and differ elsewhere meet but are
not emitted. What is left is verified by an automaton of ``e + 1`` bit vectors, each as wide as the band of diagonals.

* null text: no lines, stays null; a text all of whose lines go becomes empty;
* repeated rows (same id and text) are one document: the same lines go from each;
* null ids are the earliest; no rows: no rows;
* ``n_lines`` and ``n_removed`` of the input are replaced; other columns pass, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casegraph.llm.columns import set_aside
from casegraph.session import checked, drop_table, fits, materialize


@dataclass(frozen=True)
class Settings:
    edits: int = 2
    chars_per_edit: int = 20
    #: Documents that would lose a larger share of their characters stay whole; 1 for no exception.
    max_loss: float = 1.0
    #: Line ids are broadcast up to this checked number of them.
    max_broadcast: int = 500_000


#: Letters whose counts are compared.
LETTERS = "etnoairshdlucmpg"
#: Code of each count: ones move in from below, then out again, so that the distance in bits is that round the ring of 8.
RING = [(1 << n) - 1 if n <= 4 else 15 & ~((1 << (n - 4)) - 1) for n in range(8)]


def lines_of(docs: DataFrame, id: str, text: str) -> DataFrame:
    """A row per line that is not blank: its document, place, length, folded text and hash."""
    # texts are folded as a whole; what a line needs then is cheap, as the optimiser repeats it in filters
    lines = docs.select(F.col(id).alias("doc"), F.xxhash64(text).alias("version"), F.posexplode(F.split(F.lower(text), "\n")))
    lines = lines.withColumn("folded", F.trim("col")).withColumn("chars", F.char_length("folded"))
    lines = lines.where(F.col("chars") > 0)
    return lines.select(
        "doc", "version", F.col("pos").alias("line"), "chars", "folded",
        F.xxhash64("folded").alias("h1"), F.xxhash64(F.lit(7), "folded").alias("h2"),
    )


def allowed(chars: Column, settings: Settings) -> Column:
    """Edits within which a line of this length is near another that is not shorter."""
    return F.least(F.lit(settings.edits), F.floor(chars / settings.chars_per_edit).cast("int"))


def places(edits: int) -> list[tuple[int, int, int]]:
    """Where the segments of a line may stand in a longer one: characters shorter, segment, shift. Equal lengths come first."""
    out = []
    for shorter in range(edits + 1):
        for i in range(edits + 1):
            # at most i edits before the segment, and edits - i behind it
            for shift in range(max(-i, shorter - (edits - i)), min(i, shorter + (edits - i)) + 1):
                out.append((shorter, i, shift))
    return out


def all_places(settings: Settings) -> list[tuple[int, int, int, int]]:
    """``places`` of each number of edits, which comes first."""
    return [(e, *place) for e in range(1, settings.edits + 1) for place in places(e)]


def segment_keys(lines: DataFrame, settings: Settings) -> DataFrame:
    """``id, place, key`` of lines ``id, chars, folded``: hash of length, number and text of the segment at each of
    ``all_places``; none where a line so much shorter has another allowance. Without shift and for the own length, these
    are the segments of the line itself."""
    names = ("place", "edits", "shorter", "i", "shift")
    options = [F.struct(*(F.lit(v).alias(n) for v, n in zip((n, *p), names))) for n, p in enumerate(all_places(settings))]
    rows = lines.select("id", "chars", "folded", F.explode(F.array(*options)).alias("at")).select("id", "chars", "folded", "at.*")
    length, parts = F.col("chars") - F.col("shorter"), F.col("edits") + 1
    rows = rows.where(allowed(length, settings) == F.col("edits"))
    base = F.floor(length / parts).cast("int")
    short = parts - length % parts  # the segments behind these are one longer
    begin = base * F.col("i") + F.greatest(F.lit(0), F.col("i") - short) + F.col("shift")
    segment = F.substring("folded", begin + 1, base + (F.col("i") >= short).cast("int"))
    return rows.select("id", "place", F.xxhash64("edits", "i", length, segment).alias("key"))


def letter_counts() -> Column:
    """Counts of some letters, modulo 8, four bits each: a ring code, in which neighbouring counts differ in one bit."""

    def add(total: Column, letter: Column) -> Column:
        count = F.col("chars") - F.char_length(F.replace(F.col("folded"), letter, F.lit("")))
        code = F.element_at(F.array(*(F.lit(v).cast("long") for v in RING)), (count % 8 + 1).cast("int"))
        return F.shiftleft(total, 4).bitwiseOR(code)

    return F.aggregate(F.array(*(F.lit(c) for c in LETTERS)), F.lit(0).cast("long"), add)


def counts_differ(a: str, b: str) -> Column:
    """A lower bound of the sum of differences of the counts."""
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def within_edits(a: Column, b: Column, edits: int) -> Column:
    """Whether the edit distance of two arrays of characters is at most ``edits``.

    State ``e`` is a bit vector over the diagonals ``-edits..edits``: which are reached with ``e`` edits when so many
    characters of ``b`` are read. The vectors of all ``e`` stand in one integer, a lane each, and move together.
    Lines here are of about equal length, so the band covers them.
    """
    width, lane = 2 * edits + 1, 2 * edits + 2  # a bit between lanes stays clear
    lanes = [lane * e for e in range(edits + 1)]
    full = sum(((1 << width) - 1) << at for at in lanes)
    start = sum(((1 << (e + 1)) - 1) << (edits + at) for e, at in enumerate(lanes))  # e characters of a may be skipped
    copies = sum(1 << at for at in lanes)

    def equal_at(j: Column) -> Column:
        """Bit k: does b's character j equal a's character j + k - edits?"""
        own = F.get(b, j)
        out = F.lit(0).cast("long")
        for k in range(width):
            other = F.get(a, j + (k - edits)) if k >= edits else F.when(j >= edits - k, F.get(a, j - (edits - k)))
            out = out + F.when(other == own, F.lit(1 << k)).otherwise(F.lit(0))
        return out

    def step(state: Column, equal: Column) -> Column:
        up = F.shiftleft(state, lane)  # one edit more
        # a character equal, replaced, or one more in b
        new = state.bitwiseAND(equal * copies).bitwiseOR(up).bitwiseOR(F.shiftright(up, 1))
        return new.bitwiseAND(full)

    def skip(state: Column) -> Column:  # one more in a
        return state.bitwiseOR(F.shiftleft(state, lane + 1)).bitwiseAND(full)

    def step_and_skip(state: Column, equal: Column) -> Column:
        # the skips of the state before come first: as many as there may be
        return step(_repeat(skip, state, edits), equal)

    equal = F.transform(F.sequence(F.lit(0), F.size(b) - 1), equal_at)
    last = F.aggregate(equal, F.lit(start).cast("long"), step_and_skip, lambda state: _repeat(skip, state, edits))
    gap = F.size(a) - F.size(b)
    bit = F.call_function("shiftright", last, gap + edits + lanes[-1]).bitwiseAND(1) == 1
    return F.when(F.abs(gap) > edits, F.lit(False)).when(F.size(b) == 0, F.lit(True)).otherwise(bit)


def _repeat(move, state: Column, times: int) -> Column:
    for _ in range(times):
        state = move(state)
    return state


def _small(df: DataFrame, settings: Settings) -> DataFrame:
    return F.broadcast(df) if fits(df, settings.max_broadcast) else checked(df)


def segment_rows(lines: DataFrame, settings: Settings) -> DataFrame:
    """``id, place, key`` of all segments that lines share with others; ``place`` is an index of ``all_places``."""
    lines = lines.where(F.col("chars") >= settings.chars_per_edit).select(F.col("h1").alias("id"), "chars", "folded")
    rows = materialize(segment_keys(lines, settings), "line-segments")
    # most segments are those of one line only: they are found by two numbers per key, and go before any join
    shared = rows.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low <> high").select("key")
    shared = materialize(shared, "shared-segments")
    kept = materialize(rows.join(_small(shared, settings), "key", "left_semi"), "segment-rows")
    drop_table(rows)
    drop_table(shared)
    return kept


def with_first(rows: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """Segment rows with their lines' ``at`` and ``counts``, the ``edits`` of the place, and ``first``, the earliest line
    that has the segment; ``texts`` are ``id, at, counts``."""
    rows = rows.join(checked(texts.select("id", "at", "counts")), "id")
    first = rows.groupBy("key").agg(F.min(F.struct("at", "id", "counts")).alias("first"))
    edits = F.element_at(F.array(*(F.lit(place[0]) for place in all_places(settings))), F.col("place") + 1)
    return rows.withColumn("edits", edits).join(checked(first), "key")


def near_pairs(rows: DataFrame, settings: Settings, late: DataFrame | None = None) -> DataFrame:
    """Pairs ``b, a, edits`` of ids of lines that may be within so many edits, ``a`` earlier, each pair once.

    Without ``late``: each line and the first line that has one of its segments. With it: all other pairs of which the later
    line is not in ``late``. ``rows`` are those of ``with_first``.
    """
    where = all_places(settings)
    if late is None:
        near = counts_differ("counts", "first.counts") <= 2 * F.col("edits")
        pairs = rows.where((F.col("id") != F.col("first.id")) & near)
        return pairs.select(F.col("id").alias("b"), F.col("first.id").alias("a"), "edits").distinct()
    open_ = rows.join(checked(late.select("id")), "id", "left_anti")
    own = F.col("place").isin([n for n, place in enumerate(where) if place[1] == 0 and place[3] == 0])
    shorter = F.col("place").isin([n for n, place in enumerate(where) if place[1] > 0])

    def met(later: DataFrame, earlier: DataFrame) -> DataFrame:
        b = later.select("key", "edits", F.col("first.id").alias("lead"), *(F.col(c).alias(f"{c}_b") for c in ("id", "at", "counts")))
        a = earlier.select("key", *(F.col(c).alias(f"{c}_a") for c in ("id", "at", "counts")))
        near = counts_differ("counts_a", "counts_b") <= 2 * F.col("edits")
        both = b.join(checked(a), (b["key"] == a["key"]) & (F.col("id_a") != F.col("lead")) & (F.col("at_a") < F.col("at_b")) & near)
        return both.select(F.col("id_b").alias("b"), F.col("id_a").alias("a"), "edits")

    # a line meets those that are not longer under their own segments; the shorter one may also be the later
    return met(open_, rows.where(own)).union(met(open_.where(own), rows.where(shorter))).distinct()


def verified(pairs: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """``id`` of the later lines of the pairs that are within the edits."""
    for side in ("b", "a"):
        # letters as an array take sixteen times the bytes of the text, and far more than in their file
        pairs = pairs.join(checked(texts.select(F.col("id").alias(side), F.col("letters").alias(f"letters_{side}"))), side)
    near = F.lit(False)
    for edits in range(1, settings.edits + 1):
        near = F.when(F.col("edits") == edits, within_edits(F.col("letters_b"), F.col("letters_a"), edits)).otherwise(near)
    return pairs.where(near).select(F.col("b").alias("id")).distinct()


def late_lines(rows: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """``id`` of the lines of which one within the allowed edits stands earlier; ``texts`` are ``id, at, counts, letters``."""
    rows = materialize(with_first(rows, texts, settings), "segments-and-first")
    led = materialize(verified(near_pairs(rows, settings), texts, settings), "lines-near-the-first")
    rest = materialize(verified(near_pairs(rows, settings, led), texts, settings), "lines-near-others")
    drop_table(rows)
    return led.union(rest)


def removed_lines(docs: DataFrame, id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """``doc, version, line`` of the lines to remove."""
    lines = lines_of(docs, id, text)
    place = F.struct("doc", "version", "line")

    # equal lines: places and hashes are written once; only hashes that occur again are looked at any further
    slim = materialize(lines.select("doc", "version", "line", "h1", "h2"), "line-hashes")
    again = slim.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h1", "h2")
    again = materialize(again, "equal-lines")
    equal = materialize(slim.join(_small(again, settings), ["h1", "h2"], "left_semi"), "equal-line-places")
    drop_table(slim)
    drop_table(again)
    first = materialize(equal.groupBy("h1", "h2").agg(F.min(place).alias("first")), "first-lines")
    # many places of one line are on the left; on the right it is one row
    repeats = equal.join(_small(first, settings), ["h1", "h2"]).where(place != F.col("first")).select("doc", "version", "line")
    if settings.edits < 1:
        return repeats.distinct()

    # each different line once, where it stands first
    different = lines.join(_small(first, settings), ["h1", "h2"], "left").where(F.col("first").isNull() | (place == F.col("first")))
    rows = segment_rows(different, settings)
    wanted = materialize(rows.select(F.col("id").alias("h1")).distinct(), "lines-with-shared-segments")
    texts = different.join(_small(wanted, settings), "h1", "left_semi")
    # of lines that share a segment only
    texts = texts.select(F.col("h1").alias("id"), place.alias("at"), letter_counts().alias("counts"), F.split("folded", "").alias("letters"))
    # written, so that a line is taken apart once and not for each of its letters
    texts = materialize(texts.dropDuplicates(["id"]), "line-texts")
    late = texts.join(checked(late_lines(rows, texts, settings)), "id", "left_semi")
    removed = materialize(repeats.union(late.select("at.*")).distinct(), "removed-lines")
    for table in (equal, first, rows, wanted, texts):
        drop_table(table)
    return removed


def without_repeated_lines(docs: DataFrame, id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """``docs`` with texts without the removed lines; all rows and columns stay."""
    aside, restore = set_aside(docs, ["n_lines", "n_removed"])
    return restore(dedup_lines(aside, id, text, settings))


def dedup_lines(docs: DataFrame, id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """``docs`` with texts without the removed lines, and ``n_lines`` and ``n_removed`` of each."""
    counts = ["n_lines", "n_removed"]
    removed = removed_lines(docs.select(id, text), id, text, settings)
    few = fits(removed, settings.max_broadcast)
    removed = removed.groupBy("doc", "version").agg(F.collect_list("line").alias("gone"))
    removed = removed if few else checked(removed)
    # the other columns travel in one, so that none can clash
    others = [c for c in docs.columns if c != text and c.lower() not in counts]
    packed = docs.select(F.col(id).alias("id"), F.xxhash64(text).alias("hash"), F.col(text).alias("text"), F.struct(*others).alias("row"))
    same = packed["id"].eqNullSafe(removed["doc"]) & (packed["hash"] == removed["version"])
    # a column of its own, so that a text is split once and not for each of its lines
    joined = packed.join(removed, same, "left").withColumn("lines", F.split("text", "\n"))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    joined = joined.withColumn("kept", F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n"))
    lost = F.char_length("text") - F.char_length("kept")
    cut = F.coalesce(lost <= settings.max_loss * F.char_length("text"), F.lit(False))
    results = {
        text: F.when(cut, F.col("kept")).otherwise(F.col("text")),
        "n_lines": F.when(F.col("text").isNull(), 0).otherwise(F.size("lines")).cast("long"),
        "n_removed": F.when(cut, F.size("gone")).otherwise(0).cast("long"),
    }
    columns = [c for c in docs.columns if c.lower() not in counts] + counts
    return joined.select(*(results[c].alias(c) if c in results else F.col("row")[c].alias(c) for c in columns))
