"""Small binary files in the shared folder, written and mapped by tasks.

The folder is named by ``spark.checkpoint.dir``; any store that pyarrow can open will do. A file
appears whole or not at all, under a name that does not depend on the attempt that wrote it, so
a task that runs again after a lost executor replaces its file by an equal one.
"""

from __future__ import annotations

import mmap
import os
import tempfile
import uuid

import numpy as np
from pyarrow import fs


def opened(url: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URL or of a plain path."""
    if "://" not in url and not url.startswith("file:"):
        return fs.LocalFileSystem(), url
    if url.startswith("file:"):
        return fs.LocalFileSystem(), "/" + url[5:].lstrip("/")
    return fs.FileSystem.from_uri(url)


def write_file(url: str, data: bytes | list) -> None:
    """Write a file (bytes, or a list of bytes-like parts) and only then give it its name."""
    store, path = opened(url)
    parent = path.rpartition("/")[0]
    store.create_dir(parent, recursive=True)
    attempt = f"{parent}/.{path.rpartition('/')[2]}-{uuid.uuid4().hex}"
    with store.open_output_stream(attempt) as out:
        for part in data if isinstance(data, list) else [data]:
            out.write(part)
    store.move(attempt, path)


def read_file(url: str) -> bytes:
    store, path = opened(url)
    with store.open_input_stream(path) as source:
        return source.read()


def mapped(url: str, dtype: str) -> np.ndarray:
    """The file's values, mapped into memory. From a remote store a copy without a name is
    mapped, which goes when the process ends."""
    store, path = opened(url)
    if isinstance(store, fs.LocalFileSystem):
        if not os.path.getsize(path):
            return np.empty(0, dtype)
        with open(path, "rb") as f:
            return np.frombuffer(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ), dtype)
    with tempfile.TemporaryFile() as f, store.open_input_stream(path) as source:
        while part := source.read(1 << 24):
            f.write(part)
        f.flush()
        if not f.tell():
            return np.empty(0, dtype)
        return np.frombuffer(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ), dtype)
