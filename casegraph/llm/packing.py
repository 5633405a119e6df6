"""Cost-balanced packing of token ids into sequences of a fixed length.

The cost of a piece in a sequence is linear (projections) plus quadratic (attention) in its length. Whole
sequences are cut from long documents first; what is left of each document is assigned in descending order to
the sequence of lowest cost that has room. A piece that fits nowhere is cut at the room that is left, so every
sequence is full. The rest of a partition, less than a sequence, goes to sequences whose lengths are powers of two.

Documents are packed where they are read: no shuffle, and a task holds one block of ``block_tokens`` at a time.

* null or empty text: only the end id;
* repeated rows: packed as often as they occur; null ids pass through;
* no rows: no rows; other columns are not carried.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType

from casegraph.llm.tokens import default_path, encoder

END_ID = 0


@dataclass
class Piece:
    doc: object
    start: int
    length: int
    doc_tokens: int
    ids: memoryview  # of the piece

    def cut(self, n: int) -> tuple[Piece, Piece]:
        """The first ``n`` ids, and the others."""
        a = Piece(self.doc, self.start, n, self.doc_tokens, self.ids[: 4 * n])
        return a, Piece(self.doc, self.start + n, self.length - n, self.doc_tokens, self.ids[4 * n :])


def assign(pieces: list[Piece], capacities: list[int], linear: float, quadratic: float) -> tuple[list[list[Piece]], list[Piece]]:
    """Fill sequences of the given capacities; also what is left over, which is something only if all are full."""
    members: list[list[Piece]] = [[] for _ in capacities]
    room = list(capacities)
    cheapest = [(0.0, i) for i in range(len(capacities))]  # open sequences by cost
    heapq.heapify(cheapest)
    # descending by length, ties in reading order; a rest that was cut off is queued by its own length
    queue = [(-p.length, n, p) for n, p in enumerate(pieces)]
    heapq.heapify(queue)
    n = len(pieces)

    def put(piece: Piece, i: int, cost: float) -> None:
        members[i].append(piece)
        room[i] -= piece.length
        if room[i]:
            heapq.heappush(cheapest, (cost + linear * piece.length + quadratic * piece.length**2, i))

    while queue and cheapest:
        piece = heapq.heappop(queue)[2]
        passed = []
        while cheapest and room[cheapest[0][1]] < piece.length:
            passed.append(heapq.heappop(cheapest))
        if cheapest:
            cost, i = heapq.heappop(cheapest)
            put(piece, i, cost)
        else:  # it fits nowhere: fill the sequence with most room
            best = max(range(len(passed)), key=lambda k: room[passed[k][1]])
            cost, i = passed.pop(best)
            head, rest = piece.cut(room[i])
            put(head, i, cost)
            heapq.heappush(queue, (-rest.length, n, rest))
            n += 1
        for entry in passed:
            heapq.heappush(cheapest, entry)
    return members, [p for _, _, p in sorted(queue, key=lambda q: q[1])]


def pack(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    length: int = 1024,
    linear: float = 1.0,
    quadratic: float = 1.0 / 4096,
    block_tokens: int = 1 << 20,
) -> DataFrame:
    """One row per piece: ``id, start, length, doc_tokens, sequence_id, offset`` and its ``ids`` (little-endian, 32 bits each)."""
    path = path or default_path()
    docs = docs.select(id, text)
    fields = "start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    schema = StructType([StructField(id, docs.schema[id].dataType), *StructType.fromDDL(fields)])
    id_type: list[pa.DataType] = []

    def table(sequences: list[list[Piece]], number: int) -> pa.RecordBatch:
        columns: list[list] = [[] for _ in schema]
        for sequence in sequences:
            offset = 0
            for p in sequence:
                for column, value in zip(columns, (p.doc, p.start, p.length, p.doc_tokens, number, offset, bytes(p.ids))):
                    column.append(value)
                offset += p.length
            number += 1
        types = [id_type[0], *[pa.int64()] * 5, pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[f.name for f in schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        number = TaskContext.get().partitionId() << 40
        waiting: list[Piece] = []
        waiting_tokens = 0
        for batch in batches:
            id_type[:] = [batch.column(0).type]
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                whole: list[list[Piece]] = []
                for doc, ids in zip(part.column(0).to_pylist(), encode(part.column(1).to_pylist())):
                    ids += END_ID.to_bytes(4, "little")
                    n = len(ids) // 4
                    rest = Piece(doc, 0, n, n, memoryview(ids))
                    while rest.length >= length:
                        head, rest = rest.cut(length)
                        whole.append([head])
                    if rest.length:
                        waiting.append(Piece(doc, rest.start, rest.length, n, memoryview(bytes(rest.ids))))
                        waiting_tokens += rest.length
                if whole:
                    yield table(whole, number)
                    number += len(whole)
                if waiting_tokens >= block_tokens:
                    full, waiting = assign(waiting, [length] * (waiting_tokens // length), linear, quadratic)
                    yield table(full, number)
                    number += len(full)
                    waiting_tokens = sum(p.length for p in waiting)
        if waiting:
            capacities = [length] * (waiting_tokens // length)
            rest = waiting_tokens % length
            capacities += [1 << k for k in reversed(range(rest.bit_length())) if rest >> k & 1]
            yield table(assign(waiting, capacities, linear, quadratic)[0], number)

    return docs.mapInArrow(run, schema)
