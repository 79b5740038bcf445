"""Binary files in the shared folder, opened from inside tasks.

Paths are URIs under ``spark.checkpoint.dir``; Arrow's file systems open
them, so the folder may be a shared mount, HDFS or an object store. A file
appears under its name only when complete, so a task that is run again
replaces it with the same content.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyarrow import fs


def locate(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


@contextmanager
def replacing(path: str):
    """An output stream whose file gets its name on success."""
    system, name = locate(path)
    system.create_dir(name.rpartition("/")[0], recursive=True)
    temporary = f"{name}.{uuid.uuid4().hex}.part"
    with system.open_output_stream(temporary) as out:
        yield out
    system.move(temporary, name)


def opened(path: str):
    system, name = locate(path)
    return system.open_input_file(name)
