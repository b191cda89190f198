"""Binary files that tasks write to and read from the shared folder, over whatever store its address names."""

from __future__ import annotations

import os
import uuid

from pyarrow import fs


def opened(address: str) -> tuple[fs.FileSystem, str]:
    """The file system of an address and the path in it; an address without a scheme is a local path."""
    if "://" not in address and not address.startswith("file:"):
        return fs.LocalFileSystem(), os.path.abspath(address)
    return fs.FileSystem.from_uri(address)


def make_folder(address: str) -> None:
    store, path = opened(address)
    store.create_dir(path, recursive=True)


class Upload:
    """A file that gets its name only once it is whole, so that a task that dies leaves nothing readable.

    Every attempt writes a file of its own: a repeated task never touches what another one has published.
    """

    def __init__(self, folder: str, suffix: str) -> None:
        self.store, base = opened(folder)
        self.name = f"{uuid.uuid4().hex}{suffix}"
        self.path = f"{base}/{self.name}"
        self.stream = self.store.open_output_stream(f"{self.path}.tmp", compression=None)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.stream.close()
        self.store.move(f"{self.path}.tmp", self.path)


class Reader:
    """Byte ranges of the files of a folder."""

    def __init__(self, folder: str) -> None:
        self.store, self.base = opened(folder)
        self.name, self.file = None, None

    def read(self, name: str, offset: int, length: int) -> bytes:
        if name != self.name:
            self.close()
            self.name, self.file = name, self.store.open_input_file(f"{self.base}/{name}")
        data = self.file.read_at(length, offset)
        if len(data) != length:
            raise OSError(f"{name} ends before byte {offset + length}.")
        return data

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
        self.name, self.file = None, None
