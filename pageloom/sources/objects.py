"""Single objects, written by name from executors: local folders and the stores that pyarrow opens (s3, gs, hdfs, abfss)."""

from __future__ import annotations

import os

from pyarrow import fs


def put(folder: str, name: str, data: bytes) -> str:
    """Writes data as folder/name, in place of what is there; returns that."""
    place = f"{folder.rstrip('/')}/{name}"
    store, path = fs.FileSystem.from_uri(place) if "://" in place else (fs.LocalFileSystem(), os.path.abspath(place.removeprefix("file:")))
    if isinstance(store, fs.LocalFileSystem):
        os.makedirs(os.path.dirname(path), exist_ok=True)
    with store.open_output_stream(path) as f:
        f.write(data)
    return place
