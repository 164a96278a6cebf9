"""Binary files in the shared folder, written and range-read inside tasks.

The folder is the one that the cluster names in ``spark.checkpoint.dir``; any
store that pyarrow knows by URI works (file, hdfs, s3, gs)."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyarrow import fs


def resolve(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


@contextmanager
def created(uri: str):
    """An output stream whose file appears under ``uri`` only when it is whole:
    a task that is tried again, or twice at once, leaves one complete file."""
    store, path = resolve(uri)
    folder = path.rsplit("/", 1)[0]
    store.create_dir(folder, recursive=True)
    partial = f"{folder}/.{path.rsplit('/', 1)[1]}.{uuid.uuid4().hex}"
    with store.open_output_stream(partial) as out:
        yield out
    store.move(partial, path)


class RangeReader:
    """Reads byte ranges of one file."""

    def __init__(self, uri: str):
        store, path = resolve(uri)
        self._file = store.open_input_file(path)
        self.size = self._file.size()

    def read(self, offset: int, length: int) -> bytes:
        if offset < 0 or length < 0 or offset + length > self.size:
            raise ValueError(f"range {offset}+{length} is outside the file of {self.size} bytes")
        return self._file.read_at(length, offset)

    def close(self) -> None:
        self._file.close()

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.close()
