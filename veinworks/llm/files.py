"""Files that tasks write and read in a folder all executors share."""

from __future__ import annotations

import pyarrow as pa


def filesystem(uri: str):
    """(pyarrow file system, path) of a URI such as file:///x, hdfs://host/x or s3://bucket/x."""
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return fs.FileSystem.from_uri(uri)


def task_name(prefix: str, suffix: str) -> tuple[int, str]:
    """(partition, file name) of the running task.

    The attempt is part of the name: a retried or speculative attempt never
    meets the file of another, and only the rows of the one that succeeds, with
    its file name, reach the index.
    """
    from pyspark import TaskContext

    context = TaskContext.get()
    return context.partitionId(), f"{prefix}-{context.partitionId():06d}-{context.taskAttemptId()}{suffix}"


def coalesce(ranges: list[tuple[int, int]], gap: int, most: int) -> list[tuple[int, int]]:
    """Sorted (offset, length) ranges joined where at most ``gap`` bytes lie between them.

    A joined range has at most ``most`` bytes, unless one range alone is longer.
    """
    out: list[list[int]] = []
    for offset, length in sorted(ranges):
        if out and offset - out[-1][1] <= gap and max(offset + length, out[-1][1]) - out[-1][0] <= most:
            out[-1][1] = max(out[-1][1], offset + length)
        else:
            out.append([offset, offset + length])
    return [(a, b - a) for a, b in out]


def read_at(file: pa.NativeFile, offset: int, length: int) -> bytes:
    data = file.read_at(length, offset)
    if len(data) != length:
        raise OSError(f"file ends before {offset + length}")
    return data
