"""SimHash near-duplicates by a self-join of the binary trie of fingerprints.

A node of the trie is a prefix of fingerprint bits. Node pairs are traversed together: each step goes one level
down on both sides, adds a differing bit to the pair's count, and drops the pair as soon as the count is over
the budget. The upper levels are traversed as joins of node tables, four bits a step, until no node holds more
than ``node_size`` fingerprints; each remaining pair of nodes is traversed bit by bit in a task of its own.
A task reports a spanning forest of the links it found, so a dense group never yields all its pairs.

* null or empty text, or no words: fingerprint zero, which links like any other;
* fewer words than a shingle has: one shingle of them all;
* repeated rows and equal texts share a fingerprint; only distinct fingerprints are compared;
* null ids: such rows get their group's smallest id that is not null;
* no rows: no rows; columns named like a result are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegraph.llm.components import components
from casegraph.llm.words import LOWER, NON_SPACE, append_columns, find_words, slices
from casegraph.session import checked, fits, materialize

BITS = 64
STEP = 4  # bits per join of node tables
_BLOCK = 1 << 17  # shingles, or node pairs, handled at once


def fingerprint_texts(column: pa.Array, width: int = 3, seed: int = 42) -> dict[str, np.ndarray]:
    parts = [np.zeros(0, dtype=np.int64)]
    digest = xxhash.xxh64_intdigest
    for piece in slices(column):
        data = LOWER[piece.data]
        words = find_words(piece, NON_SPACE, data)
        length = words.end - words.start
        # the words joined by one space each, so that a shingle is a run of bytes
        stop = np.cumsum(length + 1) - 1
        start = stop - length
        joined = np.full(int(length.sum() + len(length)), 0x20, dtype=np.uint8)
        filled = np.ones(len(joined), dtype=bool)
        filled[stop] = False
        joined[filled] = data[NON_SPACE[data]]
        raw = joined.tobytes()
        n_words = words.counts(piece.n)
        last = np.cumsum(n_words)
        n_shingles = np.where(n_words > 0, np.maximum(n_words - width + 1, 1), 0)
        text = np.repeat(np.arange(piece.n), n_shingles)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(n_shingles) - n_shingles, n_shingles)
        first = (last - n_words)[text] + nth
        begin, end = start[first], stop[np.minimum(first + width, last[text]) - 1]
        set_bits = np.zeros((piece.n, BITS), dtype=np.int64)
        for at in range(0, len(text), _BLOCK):
            block = slice(at, at + _BLOCK)
            spans = zip(begin[block].tolist(), end[block].tolist())
            h = np.fromiter((digest(raw[a:b], seed) for a, b in spans), dtype=np.uint64, count=len(text[block]))
            bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            owner = text[block]
            new = np.flatnonzero(np.diff(owner, prepend=-1))
            set_bits[owner[new]] += np.add.reduceat(bits, new, axis=0, dtype=np.int32)
        majority = (2 * set_bits > n_shingles[:, None]).astype(np.uint8)
        parts.append(np.packbits(majority, axis=1, bitorder="little").reshape(-1).view(np.int64))
    return {"fingerprint_bits": np.concatenate(parts)}


def fingerprints(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``fingerprint_bits``, a 64-bit integer."""
    return append_columns(docs, text, "fingerprint_bits long", fingerprint_texts, keep)


class _Forest:
    """Groups of positions, joined by arrays of links."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, u: np.ndarray, v: np.ndarray) -> None:
        while True:
            a, b = self.root[u], self.root[v]
            open_ = a != b
            if not open_.any():
                return
            u, v, a, b = u[open_], v[open_], a[open_], b[open_]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = self.root[self.root]
                if np.array_equal(up, self.root):
                    break
                self.root = up


def _ones_before(values: np.ndarray, level: int) -> np.ndarray:
    sums = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum((values >> np.uint64(BITS - 1 - level)) & np.uint64(1), out=sums[1:])
    return sums


def trie_links(x: np.ndarray, y: np.ndarray | None, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two sorted sets of fingerprints, or within ``x`` if ``y`` is None."""
    alone = y is None
    values = x if alone else np.concatenate([x, y])
    shift = 0 if alone else len(x)
    y = x if alone else y
    forest = _Forest(len(values))
    ones: list[tuple[np.ndarray, np.ndarray]] = []
    # a pair of nodes: the range of each in its sorted set, and the differing bits so far
    stack = [(0, np.array([[0, len(x), 0, len(y), 0]], dtype=np.int64))]
    while stack:
        level, pairs = stack.pop()
        if len(pairs) > _BLOCK:
            stack.append((level, pairs[_BLOCK:]))
            pairs = pairs[:_BLOCK]
        xl, xh, yl, yh, d = pairs.T
        within = d + (BITS - level) <= budget  # whatever the other bits are
        small = ((xh - xl) * (yh - yl) <= 16) & ~within
        if within.any():
            for a, b, c, e in pairs[within, :4].tolist():
                forest.join(np.arange(a, b), np.full(b - a, c + shift))
                forest.join(np.arange(c, e) + shift, np.full(e - c, a))
        if small.any():
            a, b, c, e, _ = pairs[small].T
            size = (b - a) * (e - c)
            of = np.repeat(np.arange(len(size)), size)
            nth = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
            i, j = a[of] + nth // (e - c)[of], c[of] + nth % (e - c)[of]
            near = np.bitwise_count(x[i] ^ y[j]) <= budget
            forest.join(i[near], j[near] + shift)
        pairs = pairs[~(within | small)]
        if not len(pairs):
            continue
        while len(ones) <= level:
            cx = _ones_before(x, len(ones))
            ones.append((cx, cx if alone else _ones_before(y, len(ones))))
        cx, cy = ones[level]
        xl, xh, yl, yh, d = pairs.T
        xm, ym = xh - (cx[xh] - cx[xl]), yh - (cy[yh] - cy[yl])
        mirrored = (xl == yl) & (xh == yh) if alone else np.zeros(len(pairs), dtype=bool)
        below = [(xl, xm, yl, ym, d), (xm, xh, ym, yh, d), (xl, xm, ym, yh, d + 1)]
        children = [np.stack(c, axis=1) for c in below]
        children.append(np.stack((xm, xh, yl, ym, d + 1), axis=1)[~mirrored])
        children = np.concatenate(children)
        live = (children[:, 0] < children[:, 1]) & (children[:, 2] < children[:, 3]) & (children[:, 4] <= budget)
        stack.append((level + 1, children[live]))
    tied = np.flatnonzero(forest.root != np.arange(len(values)))
    a, b = values[tied], values[forest.root[tied]]
    differ = a != b
    return a[differ], b[differ]


def _prefix(depth: int):
    return F.lit(0).cast("long") if depth == 0 else F.shiftrightunsigned("fingerprint_bits", BITS - depth)


def _frontier(distinct: DataFrame, budget: int, node_size: int) -> tuple[DataFrame, DataFrame, list[int]]:
    """Nodes of bounded size that cover the trie, the pairs of them within the budget, and their depths."""
    nodes = distinct.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(0).alias("depth"), F.lit(0).cast("long").alias("prefix"), "n"
    )
    nodes = materialize(nodes, "trie-nodes")
    pairs = nodes.selectExpr("depth AS da", "prefix AS a", "depth AS db", "prefix AS b")
    depth = 0
    while depth < BITS - STEP and nodes.where(F.col("n") > node_size).limit(1).count():
        split = nodes.where(F.col("n") > node_size).select(F.col("depth").alias("d0"), F.col("prefix").alias("p0"))
        below = distinct.select(_prefix(depth).alias("p0"), _prefix(depth + STEP).alias("prefix"))
        children = below.groupBy("p0", "prefix").agg(F.count(F.lit(1)).alias("n"))
        # the root is split whenever anything is, so the first step needs no join to find the parents
        parents = children.withColumn("d0", F.lit(0)) if depth == 0 else children.join(split, "p0")
        children = parents.select("d0", "p0", F.lit(depth + STEP).alias("depth"), "prefix", "n")
        whole = nodes.where(F.col("n") <= node_size).selectExpr("depth AS d0", "prefix AS p0", "depth", "prefix", "n")
        moves = materialize(whole.unionByName(children), "trie-moves")
        left = moves.selectExpr("d0 AS da", "p0 AS a", "depth AS da2", "prefix AS a2")
        right = moves.selectExpr("d0 AS db", "p0 AS b", "depth AS db2", "prefix AS b2")
        met = pairs.join(left, ["da", "a"]).join(right, ["db", "b"])
        bits = F.bit_count(
            F.expr("shiftrightunsigned(a2, da2 - least(da2, db2))").bitwiseXOR(
                F.expr("shiftrightunsigned(b2, db2 - least(da2, db2))")
            )
        )
        once = (F.col("da") != F.col("db")) | (F.col("a") != F.col("b")) | (F.col("a2") <= F.col("b2"))
        met = met.where((bits <= budget) & once)
        pairs = materialize(met.selectExpr("da2 AS da", "a2 AS a", "db2 AS db", "b2 AS b"), "trie-pairs")
        nodes = moves.select("depth", "prefix", "n")
        depth += STEP
    depths = sorted(r["depth"] for r in nodes.select("depth").distinct().collect())  # at most one per level
    return nodes, pairs, depths


def link_fingerprints(distinct: DataFrame, budget: int = 3, node_size: int = 32_768) -> DataFrame:
    """Links ``a, b`` between distinct ``fingerprint_bits`` that connect whatever differs in at most ``budget`` bits."""
    nodes, pairs, depths = _frontier(distinct, budget, node_size)
    places = F.array(*(F.struct(F.lit(d).alias("depth"), _prefix(d).alias("prefix")) for d in depths))
    placed = distinct.select("fingerprint_bits", F.explode(places).alias("at")).select("at.*", "fingerprint_bits")
    placed = placed.join(nodes.select("depth", "prefix"), ["depth", "prefix"])
    members = placed.groupBy("depth", "prefix").agg(F.collect_list("fingerprint_bits").alias("members"))
    members = materialize(members, "trie-members")
    left = members.selectExpr("depth AS da", "prefix AS a", "members AS xs")
    right = members.selectExpr("depth AS db", "prefix AS b", "members AS ys")
    met = pairs.join(left, ["da", "a"]).join(right, ["db", "b"])

    def traverse(group: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, dtype=np.int64),) * 2]
        for row in range(group.num_rows):
            keys = {c: group.column(c)[row].as_py() for c in ("da", "a", "db", "b")}
            x, y = (
                np.sort(group.column(c)[row].values.to_numpy(zero_copy_only=False).view(np.uint64)) for c in ("xs", "ys")
            )
            alone = (keys["da"], keys["a"]) == (keys["db"], keys["b"])
            a, b = trie_links(x, None if alone else y, budget)
            found.append((a.view(np.int64), b.view(np.int64)))
        return pa.table({"a": np.concatenate([f[0] for f in found]), "b": np.concatenate([f[1] for f in found])})

    return met.groupBy("da", "a", "db", "b").applyInArrow(traverse, "a long, b long")


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", budget: int = 3, max_broadcast: int = 500_000
) -> DataFrame:
    """``id, fingerprint, component_id`` of every row; the component's id is its smallest document id."""
    marked = materialize(fingerprints(docs, text, keep=[id]), "fingerprints")
    distinct = materialize(marked.groupBy("fingerprint_bits").agg(F.min(id).alias("least")), "distinct-fingerprints")
    few = fits(marked, max_broadcast)  # no table below has more rows

    def side(df: DataFrame) -> DataFrame:
        return df if few else checked(df)

    roots = side(components(link_fingerprints(distinct, budget)))
    grouped = distinct.join(roots, distinct["fingerprint_bits"] == roots["node"], "left").select(
        "fingerprint_bits", "least", F.coalesce("root", "fingerprint_bits").alias("root")
    )
    least = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = grouped.join(side(least), "root").select("fingerprint_bits", "component_id")
    return marked.join(side(classes), "fingerprint_bits").select(
        id, F.lower(F.lpad(F.hex("fingerprint_bits"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_first(
    docs: DataFrame, id: str = "doc_id", text: str = "text", budget: int = 3, max_broadcast: int = 500_000
) -> DataFrame:
    """One document of each group: the one with the smallest id. Rows with the same id stay or go together."""
    classes = materialize(near_duplicates(docs, id, text, budget, max_broadcast), "near-duplicates")
    gone = classes.where(F.col(id) != F.col("component_id")).select(id).distinct()
    return docs.join(F.broadcast(gone) if fits(gone, max_broadcast) else checked(gone), id, "left_anti").select(*docs.columns)
