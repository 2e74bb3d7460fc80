"""Binary files in the shared folder, written and read by tasks."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow.fs as pafs


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path as Spark writes it (``file:/x``, ``/x``,
    ``hdfs://...``, ``s3://...``)."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    if uri.startswith("/"):
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


@contextmanager
def writing(folder: str, name: str, attempt: str) -> Iterator:
    """A new file that appears under its name only when complete, so a task
    that is run again, or twice at once, leaves one whole file."""
    fs, base = filesystem(folder)
    fs.create_dir(base, recursive=True)
    draft = f"{base}/_{name}.{attempt}"
    with fs.open_output_stream(draft, compression=None) as out:
        yield out
    fs.move(draft, f"{base}/{name}")


@contextmanager
def reading(folder: str, name: str) -> Iterator:
    fs, base = filesystem(folder)
    with fs.open_input_stream(f"{base}/{name}", compression=None) as source:
        yield source


def this_task() -> tuple[int, str]:
    """Partition number and a name for this attempt."""
    from pyspark import TaskContext

    context = TaskContext.get()
    return context.partitionId(), f"{context.stageId()}-{context.attemptNumber()}-{context.taskAttemptId()}"
