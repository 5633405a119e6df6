"""Labelled rows for fitting: who may be learnt from, and bounded samples of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; -1 for a null id, which is in no fold."""
    return F.coalesce((F.crc32(F.col(id).cast("string")) % folds).cast("int"), F.lit(-1))


def sample_rows(rows: DataFrame, id: str, n: int) -> DataFrame:
    """At most ``n`` ids, the same ones in every run: those with the smallest hashes."""
    return rows.where(F.col(id).isNotNull()).select(id).distinct().orderBy(F.xxhash64(id), id).limit(n)


def texts_of(docs: DataFrame, ids: DataFrame, id: str) -> DataFrame:
    """Documents with one of the ids, whose number is bounded by ``sample_rows``."""
    return docs.join(F.broadcast(ids), id)
