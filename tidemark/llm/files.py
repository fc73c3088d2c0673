"""Files that tasks write to and read from the shared folder, on any file system."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from contextlib import contextmanager

import numpy as np
from pyarrow import fs


def _split(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


@contextmanager
def written(uri: str):
    """A stream whose content appears under ``uri`` at once, when all of it is written.

    An attempt that fails leaves nothing under the name; two attempts write the same.
    """
    files, path = _split(uri)
    files.create_dir(os.path.dirname(path), recursive=True)
    draft = f"{path}.{uuid.uuid4().hex}"
    with files.open_output_stream(draft) as out:
        yield out
    files.move(draft, path)


def put(uri: str, content: bytes | memoryview) -> None:
    with written(uri) as out:
        out.write(content)


def opened(uri: str):
    """A file that can be read from any place in it."""
    files, path = _split(uri)
    return files.open_input_file(path)


def mapped(uri: str, dtype: str) -> np.ndarray:
    """A file as an array of ``dtype`` that is mapped into memory and read as it is used.

    A file of the shared folder that this machine sees as a path is mapped where it lies; one
    of another store is first copied to a file of this worker, which has no name and so goes
    with the worker.
    """
    files, path = _split(uri)
    if not isinstance(files, fs.LocalFileSystem):
        with tempfile.NamedTemporaryFile() as own, files.open_input_stream(path) as there:
            shutil.copyfileobj(there, own)
            own.flush()
            return np.memmap(own.name, dtype, "r") if own.tell() else np.empty(0, dtype)
    return np.memmap(path, dtype, "r") if os.path.getsize(path) else np.empty(0, dtype)
