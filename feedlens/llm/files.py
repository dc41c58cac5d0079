"""Files in the shared folder, for code inside Spark tasks.

The folder may be any place that Arrow's file systems reach (a mounted folder,
HDFS, an object store); a path without a scheme is a mounted folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

import pyarrow.fs as pafs


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    uri = "file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri
    return pafs.FileSystem.from_uri(uri)


def write_bytes(uri: str, *parts) -> None:
    """Write a file whole or not at all: retried and speculative tasks may race."""
    fs, path = filesystem(uri)
    fs.create_dir(os.path.dirname(path), recursive=True)
    partial = f"{path}.{uuid.uuid4().hex}"
    with fs.open_output_stream(partial) as out:
        for part in parts:
            out.write(part)
    fs.move(partial, path)


def mapped(uri: str, dtype):
    """The file as a memory-mapped array; a remote file is fetched once per worker."""
    import numpy as np

    fs, path = filesystem(uri)
    size = fs.get_file_info(path).size
    if not size:
        return np.zeros(0, dtype)
    if not isinstance(fs, pafs.LocalFileSystem):
        local = tempfile.NamedTemporaryFile(prefix="mapped-")
        with fs.open_input_stream(path) as src:
            while block := src.read(1 << 22):
                local.write(block)
        local.flush()
        out = np.memmap(local.name, dtype, "r")
        local.close()                       # the mapping keeps the bytes, the name goes
        return out
    return np.memmap(path, dtype, "r")
