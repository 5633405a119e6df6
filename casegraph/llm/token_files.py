"""Token ids in flat binary files.

A shard is three files: ``.bin``, the ids of its documents one after the other as little-endian unsigned integers
(16 bits if the vocabulary allows, else 32); ``.off``, one 64-bit offset per document and one at the end, counted
in ids from the start of the shard; ``.doc``, the 64-bit document ids. The manifest, a Parquet table, has a row per
shard with its base, the number of ids in all shards before it. Shards follow each other in ascending document id.

Tasks write their shard under a name of their own attempt, and only attempts that succeed are in the manifest, so
a lost executor leaves at most files that nobody reads. The folder must be one that all executors share.

* null or empty text: only the end id;
* null document id: first in order, stored as the smallest 64-bit integer;
* repeated rows: one entry each, in the order of their texts; no rows: no shards;
* other columns are not stored.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casegraph.llm.packing import END_ID
from casegraph.llm.tokens import default_path, encoder
from casegraph.session import materialize, shared_folder

NO_ID = -(1 << 63)
_READ_IDS = 1 << 20  # ids handed on at once


def _file_system(uri: str):
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:") :].lstrip("/")
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def write_files(docs: DataFrame, folder: str, id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Write ``docs`` to shards in ``folder``; the manifest ``shard, file, id_bytes, n_docs, n_tokens, base``."""
    path = path or default_path()
    ordered = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    ordered = ordered.repartitionByRange("id").sortWithinPartitions("id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path)
        kind = np.dtype("<u2" if tool.vocabulary_size <= 1 << 16 else "<u4")
        end = END_ID.to_bytes(4, "little")
        context = TaskContext.get()
        name = f"shard-{context.partitionId():06d}-{context.taskAttemptId()}"
        files, where = _file_system(folder)
        lengths, ids = [], []
        out = None
        for batch in batches:
            ids.append(batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False))
            for at in range(0, batch.num_rows, 64):
                encoded = [x + end for x in tool.encode(batch.column(1).slice(at, 64).to_pylist())]
                lengths.append(np.array([len(x) // 4 for x in encoded], dtype=np.int64))
                if out is None:
                    files.create_dir(where, recursive=True)
                    out = files.open_output_stream(f"{where}/{name}.bin")
                out.write(np.frombuffer(b"".join(encoded), dtype="<u4").astype(kind).tobytes())
        if out is None:
            return
        out.close()
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(lengths))]).astype("<u8")
        for suffix, values in (("off", offsets), ("doc", np.concatenate(ids).astype("<i8"))):
            with files.open_output_stream(f"{where}/{name}.{suffix}") as f:
                f.write(values.tobytes())
        row = (context.partitionId(), name, kind.itemsize, len(offsets) - 1, int(offsets[-1]))
        types = (pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.int64())
        names = ["shard", "file", "id_bytes", "n_docs", "n_tokens"]
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

    manifest = ordered.mapInArrow(run, "shard int, file string, id_bytes int, n_docs long, n_tokens long")
    manifest = materialize(manifest, "token-shards")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard, not per document
    return manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def _mapped(files, path: str, kind: str, scratch: str) -> np.ndarray:
    """A file as a memory-mapped array; a remote file is copied to ``scratch`` first."""
    from pyarrow import fs

    if not isinstance(files, fs.LocalFileSystem):
        copy = os.path.join(scratch, os.path.basename(path))
        fs.copy_files(path, copy, source_filesystem=files, destination_filesystem=fs.LocalFileSystem())
        path = copy
    return np.memmap(path, dtype=kind, mode="r")


def read_files(manifest: DataFrame, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document; ids as little-endian 32-bit integers, a shard per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                files, where = _file_system(folder)
                with tempfile.TemporaryDirectory() as scratch:
                    ids, offsets, docs = (
                        _mapped(files, f"{where}/{row['file']}.{suffix}", kind, scratch)
                        for suffix, kind in (("bin", f"<u{row['id_bytes']}"), ("off", "<u8"), ("doc", "<i8"))
                    )
                    at = 0
                    while at < len(docs):
                        stop = int(np.searchsorted(offsets, offsets[at] + np.uint64(_READ_IDS), side="right")) - 1
                        stop = min(len(docs), max(stop, at + 1))
                        bounds = offsets[at : stop + 1].astype(np.int64)
                        raw = ids[bounds[0] : bounds[-1]].astype("<u4").tobytes()
                        cuts = (4 * (bounds - bounds[0])).tolist()
                        own = np.array(docs[at:stop])
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(own, mask=own == NO_ID),
                                pa.array(bounds[:-1] + row["base"]),
                                pa.array(np.diff(bounds)),
                                pa.array([raw[a:b] for a, b in zip(cuts, cuts[1:])], pa.binary()),
                            ],
                            names=["doc_id", "start", "n_tokens", "ids"],
                        )
                        at = stop
                    del ids, offsets, docs

    dealt = manifest.repartition(max(1, manifest.count()))  # one task per shard, where possible
    return dealt.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def new_folder(docs: DataFrame) -> str:
    return f"{shared_folder(docs.sparkSession)}/casegraph-tokens-{uuid.uuid4().hex}"
