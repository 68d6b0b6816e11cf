"""Words, lines and shingles of many texts at once, as numpy arrays over the bytes of an Arrow column."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32
BLOCK_BYTES = 1 << 18
STEP = np.uint64(0x9E3779B97F4A7C15)
FACTOR = 0xD6E8FEB86659FD93  # odd, so that its powers stay units modulo 2^64
_powers = np.ones(1, np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers (splitmix64's finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_VALUES = mix64((np.arange(256, dtype=np.uint64) + np.uint64(1)) * STEP)


def powers(n: int) -> np.ndarray:
    """The first n powers of FACTOR modulo 2^64."""
    global _powers
    if len(_powers) < n:
        steps = np.full(max(n, 2 * len(_powers)), FACTOR, np.uint64)
        steps[0] = 1
        _powers = np.cumprod(steps, dtype=np.uint64)
    return _powers[:n]


def spans_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span [start, end) of a byte array given as per-byte numbers. Spans ascend and don't overlap."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    inside = np.repeat(starts, lengths) + place
    summed = np.zeros(len(starts), np.uint64)
    full = lengths > 0
    if full.any():
        terms = values[inside] * powers(int(lengths.max()))[place]
        summed[full] = np.add.reduceat(terms, first[full])
    return mix64(summed + lengths.astype(np.uint64) * STEP)


@dataclass
class Texts:
    """A run of texts: their bytes end to end, and where each begins (one more offset than texts)."""

    raw: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def words(self, lower: bool) -> "Words":
        data = LOWERED[self.raw] if lower else self.raw
        solid = np.zeros(len(data) + 2, bool)
        solid[1:-1] = ~SPACE[data]
        starts_mask = solid[1:-1] & ~solid[:-2]
        ends_mask = solid[1:-1] & ~solid[2:]
        edges = self.offsets[1:-1]
        edges = edges[(edges > 0) & (edges < len(data))]
        starts_mask[edges] |= solid[1:-1][edges]
        ends_mask[edges - 1] |= solid[1:-1][edges - 1]
        starts, ends = np.flatnonzero(starts_mask), np.flatnonzero(ends_mask) + 1
        counts = np.searchsorted(starts, self.offsets[1:]) - np.searchsorted(starts, self.offsets[:-1])
        return Words(spans_hash(BYTE_VALUES[data], starts, ends), starts, ends, counts)


@dataclass
class Words:
    """Hash and byte span of every word, and the number of words of each text."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    counts: np.ndarray

    def bounds(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.counts)])

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each run of ``size`` words within one text, and the place of its first word."""
        n = len(self.hashes) - size + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        owner = np.repeat(np.arange(len(self.counts)), self.counts)
        inside = np.flatnonzero(owner[:n] == owner[size - 1 :])
        total = np.zeros(len(inside), np.uint64)
        for k in range(size):
            total = total * np.uint64(FACTOR) + self.hashes[inside + k]
        return mix64(total), inside


def shingle_sets(texts: Texts, size: int = 5) -> list[np.ndarray]:
    """The sorted distinct word shingles of each text; a text of fewer words is one shingle, one without words has none."""
    words = texts.words(lower=True)
    hashes, places = words.windows(size)
    bounds = words.bounds()
    cuts = np.searchsorted(places, bounds)
    result = []
    for i in range(len(texts)):
        if words.counts[i] >= size:
            result.append(np.unique(hashes[cuts[i] : cuts[i + 1]]))
        elif words.counts[i]:
            total = np.zeros(1, np.uint64)
            for h in words.hashes[bounds[i] : bounds[i + 1]]:
                total = total * np.uint64(FACTOR) + h
            result.append(mix64(total + np.uint64(words.counts[i])))
        else:
            result.append(np.zeros(0, np.uint64))
    return result


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, Texts]]:
    """Cut a string column into runs of about ``limit`` bytes (never inside a text): first row and texts. Null is empty."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None and data_buffer.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
        stop = min(stop, n)
        yield row, Texts(data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row])
        row = stop
    pa.default_memory_pool().release_unused()  # a worker serves many stages; what the last batch needed goes back
