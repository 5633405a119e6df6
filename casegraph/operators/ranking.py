"""Global positions without a global sort in one task.

``dense_index`` and ``prefix_sums`` range-partition the sorted distinct keys, write them
once, and add the offsets of the preceding partitions (one number per partition).
``hash_cut`` finds the n-th row in hash order: it needs one count per hash bucket and a
look at the single bucket in which the cut lies. Splits and samples are then plain
row predicates: the data itself is neither shuffled nor ranked.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casegraph.session import materialize

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below

# Hash buckets by leading hex digits: 16**4 counts are all the driver ever sees.
_BUCKET_DIGITS = 4


def _sorted_in_ranges(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``df`` globally sorted over range partitions, with partition ``_part`` and position ``_pos`` in it.

    Range bounds are sampled, so the outcome is written before anything is counted on it.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = ranged.withColumn("_id", F.monotonically_increasing_id())
    written = materialize(numbered, name)
    return written.select(
        *df.columns,
        F.shiftright("_id", _ROW_BITS).alias("_part"),
        F.col("_id").bitwiseAND((1 << _ROW_BITS) - 1).alias("_pos"),
    )


def _with_offsets(parts: DataFrame, totals: Sequence[Column]) -> DataFrame:
    """Running totals of the partitions before each one: one row per range partition,
    a number fixed by the shuffle settings and independent of the data."""
    names = [f"_t{i}" for i in range(len(totals))]
    rows = parts.groupBy("_part").agg(*[t.alias(n) for t, n in zip(totals, names)]).orderBy("_part").collect()
    running = [0] * len(names)
    offsets = []
    for row in rows:
        offsets.append((row["_part"], *running))
        running = [r + (row[n] or 0) for r, n in zip(running, names)]
    schema = ", ".join(["_part bigint", *[f"_o{i} bigint" for i in range(len(names))]])
    return F.broadcast(parts.sparkSession.createDataFrame(offsets, schema))


def dense_index(df: DataFrame, key: str, name: str = "idx") -> DataFrame:
    """Distinct non-null keys with positions 0..N-1 in ascending order (strings by code point)."""
    keys = df.where(F.col(key).isNotNull()).select(key).distinct()
    placed = _sorted_in_ranges(keys, [key], "index")
    offsets = _with_offsets(placed, [F.count(F.lit(1))])
    return placed.join(offsets, "_part").select(key, (F.col("_o0") + F.col("_pos")).alias(name))


def positions(df: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """All rows with their 0-based place in the ascending ``order``; the places of equal rows are arbitrary, but fixed.

    Equal rows are told apart by a hash of their number, so that many of them still fill several ranges.
    """
    salted = df.withColumn("_salt", F.xxhash64(F.monotonically_increasing_id()))
    placed = _sorted_in_ranges(salted, [*order, "_salt"], "positions")
    offsets = _with_offsets(placed, [F.count(F.lit(1))])
    return placed.join(offsets, "_part").select(*df.columns, (F.col("_o0") + F.col("_pos")).alias(name))


def prefix_sums(df: DataFrame, order: str, values: Sequence[str]) -> DataFrame:
    """``before_<value>``: sum of integer ``value`` over all rows with a smaller ``order``, which must be unique."""
    placed = _sorted_in_ranges(df, [order], "prefix")
    offsets = _with_offsets(placed, [F.sum(v) for v in values])
    window = Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    local = [F.coalesce(F.sum(v).over(window), F.lit(0)).alias(f"_l{i}") for i, v in enumerate(values)]
    return (
        placed.select("*", *local)
        .join(offsets, "_part")
        .select(*df.columns, *[(F.col(f"_o{i}") + F.col(f"_l{i}")).alias(f"before_{v}") for i, v in enumerate(values)])
    )


def category_codes(
    df: DataFrame, columns: Sequence[str], missing: str = "UNKNOWN", max_categories: int = 1000
) -> DataFrame:
    """Add ``<column>_enc``: the 0-based position of the value among the sorted distinct ones.

    Small vocabularies (checked) become a constant in the projection, so that no join and
    no shuffle of ``df`` is needed; larger ones are indexed and joined.
    """
    filled = df.withColumns({c: F.coalesce(F.col(c), F.lit(missing)) for c in columns})
    pairs = filled.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns]))
    ).distinct()
    limit = max_categories * len(columns)
    seen = pairs.limit(limit + 1).collect()
    if len(seen) <= limit:
        for c in columns:
            vocabulary = sorted(row["value"] for row in seen if row["column"] == c)
            code = F.array_position(F.lit(vocabulary), F.col(c)) - 1 if vocabulary else F.lit(None).cast("bigint")
            filled = filled.withColumn(f"{c}_enc", code)
        return filled
    for c in columns:
        filled = filled.join(dense_index(filled, c, f"{c}_enc"), c, "left")
    return filled.select(*df.columns, *[f"{c}_enc" for c in columns])


def hash_order(key: str, seed: int) -> Column:
    """Pseudo-random but repeatable sort key of a row."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")))


@dataclass(frozen=True)
class HashCut:
    """The last of the first ``n`` rows in (hash, key) order; ``hash`` is None if ``n`` is 0."""

    key: str
    seed: int
    last_hash: str | None
    last_key: object

    def includes(self) -> Column:
        if self.last_hash is None:
            return F.lit(False)
        digest = hash_order(self.key, self.seed)
        return (digest < self.last_hash) | ((digest == self.last_hash) & (F.col(self.key) <= self.last_key))


def _bucket_counts(df: DataFrame, key: str, seed: int) -> list[tuple[str, int]]:
    bucket = F.substring(hash_order(key, seed), 1, _BUCKET_DIGITS)
    rows = df.groupBy(bucket.alias("bucket")).count().collect()
    return sorted((row["bucket"], row["count"]) for row in rows)


def hash_cuts(
    df: DataFrame, key: str, seed: int, fractions: Sequence[float] = (), rows: Sequence[int] = (),
    counts: list[tuple[str, int]] | None = None,
) -> list[HashCut]:
    """Cuts after ``floor(fraction * N)`` rows for each fraction, or after given row numbers. ``key`` is unique.

    ``counts`` are the rows per hash bucket, if they are known already.
    """
    counts = _bucket_counts(df, key, seed) if counts is None else counts
    total = sum(n for _, n in counts)
    wanted = [int(f * total) for f in fractions] + [min(n, total) for n in rows]
    inside: dict[int, tuple[str, int]] = {}
    for n in {w for w in wanted if w > 0}:
        before = 0
        for bucket, size in counts:
            if before + size >= n:
                inside[n] = (bucket, n - before)
                break
            before += size
    ends: dict[tuple[str, int], tuple[str, object]] = {}
    if inside:
        spots = set(inside.values())
        digest = hash_order(key, seed)
        edge = df.select(F.col(key).alias("key"), digest.alias("hash")).withColumn(
            "bucket", F.substring("hash", 1, _BUCKET_DIGITS)
        )
        edge = edge.where(F.col("bucket").isin([b for b, _ in spots]))
        window = Window.partitionBy("bucket").orderBy("hash", "key")
        hit = F.lit(False)
        for bucket, place in spots:
            hit = hit | ((F.col("bucket") == bucket) & (F.col("place") == place))
        for row in edge.withColumn("place", F.row_number().over(window)).where(hit).collect():
            ends[(row["bucket"], row["place"])] = (row["hash"], row["key"])
    return [HashCut(key, seed, *(ends[inside[n]] if n > 0 else (None, None))) for n in wanted]


def split_exact(df: DataFrame, key: str, seed: int = 42, train: float = 0.8, validation: float = 0.1) -> DataFrame:
    """``split``: train, val or test, with exactly floor(N * share) rows up to each boundary."""
    # The upper bound is written as one number: 0.8 + 0.1 is not 0.9 in binary.
    upper = round(train + validation, 12)
    to_train, to_val = hash_cuts(df, key, seed, fractions=[train, upper])
    split = F.when(to_train.includes(), "train").when(to_val.includes(), "val").otherwise("test")
    return df.withColumn("split", split)


def split_hash(df: DataFrame, key: str, seed: int = 42, train: float = 0.8, validation: float = 0.1) -> DataFrame:
    """As ``split_exact`` with shares that hold approximately; one pass, and stable when rows are added."""
    digits = F.substring(hash_order(key, seed), 1, 8)

    def below(share: float) -> Column:
        return F.lit(True) if share >= 1 else digits < f"{math.ceil(share * 16**8):08x}"

    split = F.when(below(train), "train").when(below(round(train + validation, 12)), "val").otherwise("test")
    return df.withColumn("split", split)


def undersample(df: DataFrame, key: str, label: str, ratio: int = 2, seed: int = 42) -> DataFrame:
    """All positives and ``ratio`` times as many negatives, chosen by hash order."""
    # one pass counts the positives and, for the cut, the negatives per hash bucket
    bucket = F.when(F.col(label) == 0, F.substring(hash_order(key, seed), 1, _BUCKET_DIGITS))
    found = df.groupBy(F.col(label).alias("label"), bucket.alias("bucket")).count().collect()
    positives = sum(r["count"] for r in found if r["label"] == 1)
    counts = sorted((r["bucket"], r["count"]) for r in found if r["label"] == 0)
    (cut,) = hash_cuts(df.where(F.col(label) == 0), key, seed, rows=[ratio * positives], counts=counts)
    return df.where((F.col(label) == 1) | ((F.col(label) == 0) & cut.includes()))


def first_in_split(df: DataFrame, key: str, split: str = "test") -> DataFrame:
    """Smallest id of a split: the case that is explained when none is named."""
    return df.where(F.col("split") == split).agg(F.min(key).alias(key))
