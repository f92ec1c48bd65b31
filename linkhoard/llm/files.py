"""Binary files in the shared folder, written and read by tasks.

A task writes under a name of its own attempt and reports it in its rows, which Spark commits. Files of
attempts that failed, were lost or came second are therefore never named by an index, and need no cleanup to
be harmless. Paths are URIs of any file system pyarrow knows (``file:``, ``hdfs:``, ``s3:`` ...).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from uuid import uuid4

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import SparkSession

from ..sources.tables import work_folder


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{work_folder(spark)}/{label}-{uuid4().hex}"


def partition() -> int:
    """Number of the partition that this task works on."""
    return TaskContext.get().partitionId()


def create(folder: str, suffix: str):
    """A new file of this task in ``folder``: its URI and an output stream."""
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    name = f"part-{partition():05d}-{uuid4().hex}{suffix}"
    return f"{folder}/{name}", system.open_output_stream(f"{path}/{name}", compression=None)


def open_input(uri: str):
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def read_spans(spans: Iterable[tuple[str, int, int]], most: int = 4 << 20) -> Iterator[bytes]:
    """The bytes of each ``(uri, offset, length)``, in order. Neighbouring spans are read at once, up to ``most`` bytes."""
    opened, stream = None, None
    try:
        for uri, group in _runs(spans, most):
            if uri != opened:
                if stream:
                    stream.close()
                opened, stream = uri, open_input(uri)
            start, end = group[0][0], group[-1][0] + group[-1][1]
            data = stream.read_at(end - start, start)
            if len(data) != end - start:
                raise ValueError(f"{uri} ends before byte {end}")
            for offset, length in group:
                yield data[offset - start : offset - start + length]
    finally:
        if stream:
            stream.close()


def _runs(spans, most):
    current, group, size = None, [], 0
    for uri, offset, length in spans:
        follows = group and uri == current and group[-1][0] + group[-1][1] == offset and size + length <= most
        if group and not follows:
            yield current, group
            group, size = [], 0
        current = uri
        group.append((offset, length))
        size += length
    if group:
        yield current, group
