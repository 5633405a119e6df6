"""Words of a whole column of texts, found and hashed with array operations.

A column arrives as one UTF-8 buffer with offsets. All functions work on that buffer, a slice of about a
megabyte at a time (a single longer text is one slice), so that nothing runs per word in Python and memory
follows the longest text, not the batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

SLICE_BYTES = 1 << 20

#: Bytes of words. White space ends a word in the first table, everything but letters and digits in the second.
_space = np.ones(256, dtype=bool)
_space[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
NON_SPACE = _space
_alnum = np.zeros(256, dtype=bool)
_alnum[0x30:0x3A] = True
_alnum[0x61:0x7B] = True
_alnum[0x80:] = True
LETTERS_DIGITS = _alnum
_lower = np.arange(256, dtype=np.uint8)
_lower[0x41:0x5B] += 32
LOWER = _lower

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power_table(name: str, base: np.uint64, n: int) -> np.ndarray:
    table = _powers.get(name)
    if table is None or len(table) < n:
        size = max(n, SLICE_BYTES + (1 << 16))
        table = np.full(size, base, dtype=np.uint64)
        table[0] = 1
        np.multiply.accumulate(table, out=table)
        if size <= 4 * SLICE_BYTES:  # tables for giant texts are not kept
            _powers[name] = table
    return table


def mix(h: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def chain(*parts: np.ndarray) -> np.ndarray:
    """Hash of a sequence of hashes."""
    h = np.zeros_like(parts[0])
    for part in parts:
        h = mix(h * np.uint64(0xD6E8FEB86659FD93) + part)
    return h


@dataclass
class Slice:
    """Some whole texts: bytes, the offset of each text (one more than texts), and the first text's row."""

    data: np.ndarray
    offsets: np.ndarray
    first: int

    @property
    def n(self) -> int:
        return len(self.offsets) - 1

    def per_text(self, mask: np.ndarray) -> np.ndarray:
        """How many bytes of each text are marked."""
        sums = np.zeros(len(mask) + 1, dtype=np.int64)
        np.cumsum(mask, out=sums[1:])
        return sums[self.offsets[1:]] - sums[self.offsets[:-1]]


@dataclass
class Words:
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray  # row of the text within the slice

    def counts(self, n: int) -> np.ndarray:
        return np.bincount(self.text, minlength=n).astype(np.int64)


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Slices of a column of strings; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, at, values = column.buffers()
    offsets = np.frombuffer(at, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(values, dtype=np.uint8) if values is not None else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < n:
        stop = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        stop = min(n, max(stop, row + 1))
        yield Slice(data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row], row)
        row = stop


def find_words(piece: Slice, table: np.ndarray, data: np.ndarray | None = None) -> Words:
    """Maximal runs of bytes in ``table``; a run never crosses two texts."""
    data = piece.data if data is None else data
    inside = table[data]
    if not len(data):
        nothing = np.zeros(0, dtype=np.int64)
        return Words(nothing, nothing, nothing)
    filled = piece.offsets[:-1] < piece.offsets[1:]
    opens = np.empty_like(inside)
    opens[0] = True
    np.logical_not(inside[:-1], out=opens[1:])
    opens[piece.offsets[:-1][filled]] = True
    closes = np.empty_like(inside)
    closes[-1] = True
    np.logical_not(inside[1:], out=closes[:-1])
    closes[piece.offsets[1:][filled] - 1] = True
    start = np.flatnonzero(inside & opens)
    end = np.flatnonzero(inside & closes) + 1
    return Words(start, end, np.searchsorted(piece.offsets, start, side="right") - 1)


def hash_runs(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each run of bytes, from prefix sums of a polynomial."""
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(data * _power_table("up", _BASE, len(data) + 1)[: len(data)], out=sums[1:])
    down = _power_table("down", _BASE_INVERSE, len(data) + 1)
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def append_columns(
    df: DataFrame, text: str, types: str, compute: Callable[[pa.Array], dict[str, np.ndarray]], keep: list[str] | None = None
) -> DataFrame:
    """``df`` (or its columns ``keep``) with the arrays that ``compute`` makes of the column ``text``.

    Columns of ``df`` with the name of a new one are replaced.
    """
    fresh = StructType.fromDDL(types)
    names = {field.name.lower() for field in fresh}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in names]
    df = df.select(*dict.fromkeys([*kept, text]))
    schema = StructType([df.schema[c] for c in kept] + list(fresh))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = compute(batch.column(batch.schema.get_field_index(text)))
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            columns += [pa.array(made[field.name]) for field in fresh]
            yield pa.RecordBatch.from_arrays(columns, names=[field.name for field in schema])

    return df.mapInArrow(run, schema)
