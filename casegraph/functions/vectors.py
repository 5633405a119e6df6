"""Expressions over dense vectors stored as arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def squared_l2(a: Column, b: Column) -> Column:
    def add(acc: Column, d: Column) -> Column:
        return acc + d * d

    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") - y.cast("double")), F.lit(0.0), add)


def of_length(vector: Column, dim: int) -> Column:
    """The vector itself, null if it is null; one of another length is an error."""
    complaint = F.raise_error(F.concat(F.lit(f"expected {dim} elements, not "), F.size(vector).cast("string")))
    return F.when(vector.isNull() | (F.size(vector) == dim), vector).otherwise(complaint)


def zeros(dim: int) -> Column:
    return F.array_repeat(F.lit(0.0), dim)


def mean_of_vectors(vector: Column, dim: int) -> Column:
    """Aggregate: element-wise mean. One sum per element keeps fixed-width buffers,
    so the aggregation stays a hash aggregation with map-side combining."""
    n = F.count(vector)
    # the length is checked with the first element, which every row passes
    parts = [of_length(vector, dim) if i == 0 else vector for i in range(dim)]
    return F.array(*[F.sum(F.get(part, F.lit(i)).cast("double")) / n for i, part in enumerate(parts)])


def greatest_vector(*vectors: Column) -> Column:
    """Element-wise maximum of several vectors of one row."""
    result = vectors[0]
    for other in vectors[1:]:
        result = F.zip_with(result, other, lambda x, y: F.greatest(x, y))
    return result
