"""Files of our own formats in any store that pyarrow can open (local or mounted, HDFS, S3, GCS)."""

from __future__ import annotations

import uuid

from pyarrow import fs


def _at(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def new_file(folder: str, name: str) -> tuple[str, object]:
    """Name and stream of a new file. A repeated task writes another file; readers only open those of a manifest."""
    store, path = _at(folder)
    store.create_dir(path, recursive=True)
    uri = f"{folder}/{name}-{uuid.uuid4().hex}"
    store, path = _at(uri)
    return uri, store.open_output_stream(path)


def open_file(uri: str):
    """A stream with random access."""
    store, path = _at(uri)
    return store.open_input_file(path)
