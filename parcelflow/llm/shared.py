"""Files in the shared folder, opened from tasks by URI, as tables of their own format need."""

from __future__ import annotations

import uuid

from pyarrow import fs


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path of a URI or of an absolute path."""
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


class Target:
    """A file that appears under its name when it is complete.

    A task that runs twice writes the same bytes to a name of its own each time and moves them over.
    """

    def __init__(self, uri: str):
        self.fs, self.path = opened(uri)
        self.part = f"{self.path}.{uuid.uuid4().hex}.part"
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.out = self.fs.open_output_stream(self.part, compression=None)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.part, self.path)
