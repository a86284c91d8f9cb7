"""Files that tasks write to and read from the shared folder (any file system that pyarrow knows)."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyarrow import fs


def located(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


@contextmanager
def created(uri: str):
    """A new file that appears under its name only when it is whole: a task that is run again replaces it."""
    system, path = located(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.tmp"
    with system.open_output_stream(part) as out:
        yield out
    system.move(part, path)


def opened(uri: str):
    system, path = located(uri)
    return system.open_input_stream(path, buffer_size=1 << 20)


def opened_at(uri: str):
    system, path = located(uri)
    return system.open_input_file(path)
