"""Binary files in the shared folder, written by tasks and read by byte ranges.

Any storage that pyarrow opens by address (file:, s3:, gs:, hdfs:, plain paths) will do. A file is written
under a name of its own attempt and moved into place when complete, so a task that is lost, repeated or
run twice leaves one whole file.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs


def located(path: str) -> tuple[fs.FileSystem, str]:
    if "://" not in path and path.startswith("file:"):
        path = path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


@contextmanager
def writing(path: str) -> Iterator:
    """An output stream whose file appears at ``path`` once the block ends without an error."""
    system, place = located(path)
    folder, _, name = place.rpartition("/")
    system.create_dir(folder, recursive=True)
    attempt = f"{folder}/.{name}.{uuid.uuid4().hex}"
    try:
        with system.open_output_stream(attempt) as out:
            yield out
    except BaseException:
        system.delete_file(attempt)
        raise
    system.move(attempt, place)


class RangeReader:
    """Reads byte ranges of one file."""

    def __init__(self, path: str) -> None:
        system, place = located(path)
        self._file = system.open_input_file(place)
        self.size = self._file.size()

    def read(self, start: int, length: int) -> bytes:
        if start < 0 or length < 0 or start + length > self.size:
            raise ValueError(f"range {start}+{length} is outside a file of {self.size} bytes")
        return self._file.read_at(length, start)

    def close(self) -> None:
        self._file.close()

    def __enter__(self) -> RangeReader:
        return self

    def __exit__(self, *_) -> None:
        self.close()
