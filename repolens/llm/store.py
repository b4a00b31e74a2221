"""Raw arrays in the shared folder, written once by tasks and memory-mapped by workers."""

from __future__ import annotations

import os
import tempfile
import uuid

import numpy as np
from pyarrow import fs


class Store:
    """A folder of arrays.  Writing is idempotent: a task that runs again
    replaces its files by equal ones.  A folder that can be mapped is read in
    place; from any other store, the files that a task needs are copied to a
    temporary folder that goes with the task."""

    def __init__(self, uri: str):
        self.uri = uri
        self.copies: tempfile.TemporaryDirectory | None = None

    def _place(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.uri if "://" in self.uri or self.uri.startswith("file:") else f"file://{os.path.abspath(self.uri)}")

    def write(self, name: str, array: np.ndarray) -> None:
        system, path = self._place()
        system.create_dir(path, recursive=True)
        part = f"{path}/.{name}-{uuid.uuid4().hex}"
        with system.open_output_stream(part) as out:
            out.write(memoryview(np.ascontiguousarray(array)).cast("B"))
        system.move(part, f"{path}/{name}")

    def read(self, name: str, dtype) -> np.ndarray:
        system, path = self._place()
        found = f"{path}/{name}"
        if not isinstance(system, fs.LocalFileSystem):
            self.copies = self.copies or tempfile.TemporaryDirectory()
            local = f"{self.copies.name}/{name}"
            if not os.path.exists(local):
                fs.copy_files(found, local, source_filesystem=system, destination_filesystem=fs.LocalFileSystem())
            found = local
        if not os.path.exists(found) or not os.path.getsize(found):
            return np.zeros(0, dtype)
        return np.memmap(found, dtype=dtype, mode="r")
