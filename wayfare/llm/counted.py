"""Counted 64-bit keys: gathered in a task, sent as packed sorted runs, merged by key range, kept as sorted arrays.

A run is one row (shard, n, keys, counts): differences of sorted keys, byte planes apart, compressed. Sorted runs
of a few million keys cost a fraction of what a row per key would cost in a shuffle.
"""

import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs

RUN = "shard int, n long, keys binary, counts binary"
RUN_FIELDS = ["shard", "n", "keys", "counts"]
HELD_KEYS = 1 << 21


def pack(values: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(blob: bytes, n: int, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(pa.decompress(blob, n * size, codec="zstd", asbytes=True), np.uint8).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(dtype).reshape(-1)


def pack_keys(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.zeros(1, np.uint64)))


def unpack_keys(blob: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpack(blob, n, np.uint64), dtype=np.uint64)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of each one's counts (a column or several)."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first, axis=0)


class Counter:
    """Keys and counts of one task or one shard; merges as it grows, so it holds each key about twice at most."""

    def __init__(self, columns: int | None = None):
        shape = (0,) if columns is None else (0, columns)
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(shape, np.int64)
        self.more: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.more.append((keys, counts))
        self.held += len(keys)
        if self.held > max(HELD_KEYS, len(self.keys)):
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if self.more:
            keys = np.concatenate([self.keys, *[k for k, _ in self.more]])
            counts = np.concatenate([self.counts, *[c for _, c in self.more]])
            self.keys, self.counts = summed(keys, counts)
            self.more, self.held = [], 0
        return self.keys, self.counts


def runs(keys: np.ndarray, counts: np.ndarray, shard: np.ndarray) -> pa.RecordBatch:
    """Sorted keys and their counts as one packed run per shard."""
    order = np.argsort(shard, kind="stable")
    found, first = np.unique(shard[order], return_index=True)
    rows = [(int(s), part) for s, part in zip(found, np.split(order, first[1:]))] if len(keys) else []
    columns = [
        pa.array([s for s, _ in rows], pa.int32()),
        pa.array([len(p) for _, p in rows], pa.int64()),
        pa.array([pack_keys(keys[p]) for _, p in rows], pa.binary()),
        pa.array([pack(np.ascontiguousarray(counts[p])) for _, p in rows], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, RUN_FIELDS)


def merged_shards(batches: Iterator[pa.RecordBatch], columns: int | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Merge runs that arrive sorted by shard: shard, keys, counts."""
    at, counter = None, Counter(columns)
    for batch in batches:
        shards, sizes = batch.column("shard").to_pylist(), batch.column("n").to_pylist()
        for i, (shard, n) in enumerate(zip(shards, sizes)):
            if shard != at:
                if at is not None:
                    yield at, *counter.merge()
                at, counter = shard, Counter(columns)
            counts = unpack(batch.column("counts")[i].as_py(), n * (columns or 1), np.int64)
            counter.add(unpack_keys(batch.column("keys")[i].as_py(), n), counts.reshape(n, columns) if columns else counts)
    if at is not None:
        yield at, *counter.merge()


def write_array(uri: str, array: np.ndarray) -> None:
    """Write an array's bytes to a file of the shared folder; a second attempt of the same task replaces it."""
    filesystem, path = pafs.FileSystem.from_uri(uri)
    filesystem.create_dir(os.path.dirname(path), recursive=True)
    draft = f"{path}.{os.getpid()}"
    with filesystem.open_output_stream(draft) as out:
        out.write(np.ascontiguousarray(array).tobytes())
    filesystem.move(draft, path)


class Arrays:
    """Arrays of the shared folder, memory-mapped. Where the folder is no file system of this machine, files are fetched once a task."""

    def __init__(self, root: str):
        self.root, self.open, self.folder = root, {}, None

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.open.clear()
        if self.folder:
            self.folder.cleanup()

    def get(self, name: str, dtype, n: int) -> np.ndarray:
        if not n:
            return np.zeros(0, dtype)
        if name not in self.open:
            filesystem, path = pafs.FileSystem.from_uri(f"{self.root}/{name}")
            if filesystem.type_name != "local":
                self.folder = self.folder or tempfile.TemporaryDirectory()
                local = os.path.join(self.folder.name, name)
                with filesystem.open_input_stream(path) as source, open(local, "wb") as out:
                    while chunk := source.read(1 << 22):
                        out.write(chunk)
                path = local
            self.open[name] = np.memmap(path, dtype=dtype, mode="r", shape=(n,))
        return self.open[name]
