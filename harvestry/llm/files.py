"""Whole files in the shared folder, from tasks: plain paths, or any store that pyarrow knows."""

from __future__ import annotations

import mmap
import os
import tempfile
import uuid
from urllib.parse import unquote, urlparse

import numpy as np


def local_path(uri: str) -> str | None:
    """The path if uri is a file: address or a plain path, else None."""
    found = urlparse(uri)
    if found.scheme == "file":
        return unquote(found.path)
    return uri if not found.scheme else None


def unique(folder: str, name: str) -> str:
    """A name that no other attempt at the same task uses."""
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


class Writer:
    """A binary file that appears under its name only when it is complete."""

    def __init__(self, uri: str):
        self.uri, self.path = uri, local_path(uri)
        if self.path:
            os.makedirs(os.path.dirname(self.path), exist_ok=True)
            self.out = open(self.path + ".part", "wb")
        else:
            from pyarrow import fs

            store, where = fs.FileSystem.from_uri(uri)
            self.out = store.open_output_stream(where)
        self.size = 0

    def write(self, data) -> int:
        """Append, and return the offset at which data starts."""
        start = self.size
        self.out.write(data)
        self.size += memoryview(data).nbytes
        return start

    def close(self) -> None:
        self.out.close()
        if self.path:
            os.rename(self.path + ".part", self.path)


def mapped(uri: str) -> np.ndarray:
    """The bytes of a file, memory-mapped read-only.

    A file of another store is first copied to an unlinked file of this machine, which leaves
    nothing behind.
    """
    path = local_path(uri)
    if path:
        with open(path, "rb") as source:
            return _map(source) if os.path.getsize(path) else np.empty(0, np.uint8)
    from pyarrow import fs

    store, where = fs.FileSystem.from_uri(uri)
    with tempfile.TemporaryFile() as copy, store.open_input_stream(where) as source:
        size = 0
        while block := source.read(1 << 24):
            copy.write(block)
            size += len(block)
        copy.flush()
        return _map(copy) if size else np.empty(0, np.uint8)


def _map(file) -> np.ndarray:
    # without a handle of its own, so that a process may map as many files as it needs
    return np.frombuffer(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ, trackfd=False), np.uint8)
