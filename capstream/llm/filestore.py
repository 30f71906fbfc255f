"""Files that tasks write to, and read from, the folder the cluster shares.

Paths are URIs (``file:/...``, ``hdfs://...``, ``s3://...``) or plain paths; the
file system comes from the URI. A task writes under a name with its attempt
in it and reports the name in its rows, so a retried or speculative attempt
never overwrites another's file and only reported files are read.
"""

from __future__ import annotations

import os
import re

import pyarrow.fs as pafs


def resolve(uri: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in uri and uri.startswith("file:"):
        uri = "file://" + uri[5:]
    if re.match(r"[a-z][a-z0-9+.-]*://", uri):
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), os.path.abspath(uri)


def create(folder: str, name: str):
    """An open output stream for ``folder/name`` (parents made) and the file's path."""
    fs, root = resolve(folder)
    fs.create_dir(root, recursive=True)
    return fs.open_output_stream(f"{root}/{name}", compression=None), f"{folder.rstrip('/')}/{name}"


def open_file(path: str):
    """A seekable input file: ``read_at(size, offset)`` is a range read."""
    fs, p = resolve(path)
    return fs.open_input_file(p)


def read_range(path: str, offset: int, length: int) -> bytes:
    with open_file(path) as f:
        return f.read_at(length, offset)


def attempt_name(stem: str, suffix: str) -> str:
    """A file name no other task attempt uses."""
    from pyspark import TaskContext
    c = TaskContext.get()
    at = f"{c.partitionId():06d}-{c.stageId()}-{c.taskAttemptId()}" if c is not None else f"driver-{os.getpid()}"
    return f"{stem}-{at}-{os.urandom(4).hex()}{suffix}"
