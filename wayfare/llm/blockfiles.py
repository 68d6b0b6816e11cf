"""Files of the shared scratch folder that tasks write and read themselves: whole, by range, replaced at once."""

import io
import os
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow.fs as pafs


@contextmanager
def replacing(uri: str):
    """A stream to a draft that takes the file's place when the block ends well.

    A second attempt of a task, at the same time or later, puts the same bytes under the same name.
    """
    filesystem, path = pafs.FileSystem.from_uri(uri)
    filesystem.create_dir(os.path.dirname(path), recursive=True)
    draft = f"{path}.{uuid.uuid4().hex}"
    with filesystem.open_output_stream(draft) as out:
        yield out
    filesystem.move(draft, path)


@contextmanager
def reading(uri: str):
    """A file open for reads at any place."""
    filesystem, path = pafs.FileSystem.from_uri(uri)
    with filesystem.open_input_file(path) as source:
        yield source


def as_uri(path: str) -> str:
    """A scratch path as a uri; one without a scheme is a folder of this machine."""
    return path if "://" in path or path.startswith("file:") else f"file://{os.path.abspath(path)}"


def write_arrays(uri: str, **arrays: np.ndarray) -> None:
    held = io.BytesIO()
    np.savez(held, **arrays)
    with replacing(uri) as out:
        out.write(held.getbuffer())


def read_arrays(uri: str) -> dict[str, np.ndarray]:
    with reading(uri) as source:
        with np.load(io.BytesIO(source.read())) as found:
            return {name: found[name] for name in found.files}
