"""Flat arrays as files in a folder that all executors share."""

from __future__ import annotations

import os
import tempfile
from functools import lru_cache

import numpy as np


def file_system(uri: str):
    """The file system of a folder, and the folder's path in it."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:") :].lstrip("/")
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def write_array(folder: str, name: str, values: np.ndarray) -> None:
    files, where = file_system(folder)
    files.create_dir(where, recursive=True)
    with files.open_output_stream(f"{where}/{name}") as out:
        out.write(memoryview(np.ascontiguousarray(values)).cast("B") if len(values) else b"")


def map_array(folder: str, name: str, kind: str, scratch: str | None = None) -> np.ndarray:
    """The file as a memory-mapped array. A file on a remote store is copied to ``scratch`` first."""
    from pyarrow import fs

    files, where = file_system(folder)
    path = f"{where}/{name}"
    if not isinstance(files, fs.LocalFileSystem):
        copy = os.path.join(scratch or _scratch(), name)
        if not os.path.exists(copy):
            fs.copy_files(path, f"{copy}.{os.getpid()}", source_filesystem=files, destination_filesystem=fs.LocalFileSystem())
            os.replace(f"{copy}.{os.getpid()}", copy)
        path = copy
    if not os.path.getsize(path):
        return np.zeros(0, dtype=kind)
    return np.memmap(path, dtype=kind, mode="r")


@lru_cache(maxsize=1)
def _scratch() -> str:
    """This worker's own folder for copies of remote files."""
    return tempfile.mkdtemp(prefix="mapped-")
