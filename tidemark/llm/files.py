"""Files of formats Spark has no writer for, in the shared folder.

A task writes under a name of its own attempt and moves the finished file to its final
name, so an attempt that dies or runs twice never leaves half a file behind.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs
from pyspark import TaskContext


def located(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it that a URI or a plain path names."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:") :].lstrip("/")
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


@contextmanager
def finished_file(uri: str) -> Iterator:
    """A stream whose content appears under ``uri`` only when the block ends well."""
    store, path = located(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    context = TaskContext.get()
    own = f"{path}.{context.taskAttemptId()}.tmp" if context else f"{path}.tmp"
    stream = store.open_output_stream(own, compression=None)
    try:
        yield stream
    except BaseException:
        stream.close()
        store.delete_file(own)
        raise
    stream.close()
    store.move(own, path)


def open_file(uri: str):
    """A file to seek in."""
    store, path = located(uri)
    return store.open_input_file(path)
