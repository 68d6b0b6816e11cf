"""Document fingerprints: content-defined chunks, and how much of one text another contains.

A gear hash over the bytes marks boundaries by content, so an insertion moves only the chunks around it.
Chunking is normalised: before the usual size a boundary needs more zero bits than after it, which draws sizes
together. A fingerprint is the set of chunk digests with their lengths; containment is the share of a text's
bytes whose chunks the other text has too.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayfare.llm.common import stage, table
from wayfare.llm.textarrays import BYTE_VALUES

LEAST, USUAL, MOST = 32, 128, 1024  # bytes of a chunk
STRICT, LOOSE = 9, 5  # zero bits a boundary needs before and after the usual size
WINDOW_STEPS = 5  # 2 ** 5 bytes decide on a boundary
DIGEST = 6  # bytes of a chunk's digest


def gear(data: np.ndarray) -> np.ndarray:
    """Gear hash after each byte: every byte's value shifted left once for each byte since, over 32 bytes."""
    h = BYTE_VALUES[data] & np.uint64(0xFFFFFFFF)
    for k in range(WINDOW_STEPS):
        shift = 1 << k
        if len(h) > shift:
            moved = h.copy()
            moved[shift:] += h[:-shift] << np.uint64(shift)
            h = moved
    return h & np.uint64(0xFFFFFFFF)


def boundaries(data: np.ndarray) -> list[int]:
    """Ends of the chunks of one text."""
    n = len(data)
    if not n:
        return []
    h = gear(data)
    loose_at = np.flatnonzero((h >> np.uint64(32 - LOOSE)) == 0) + 1
    strict_at = loose_at[(h[loose_at - 1] >> np.uint64(32 - STRICT)) == 0]
    # the first boundary of each kind at or after a place, by search in the sorted lists
    ends, start = [], 0
    loose, strict = loose_at.tolist(), strict_at.tolist()
    i = j = 0
    while n - start > LEAST:
        low, usual, high = start + LEAST, start + USUAL, min(start + MOST, n)
        while j < len(strict) and strict[j] < low:
            j += 1
        if j < len(strict) and strict[j] < min(usual, high):
            end = strict[j]
        else:
            while i < len(loose) and loose[i] < usual:
                i += 1
            end = loose[i] if i < len(loose) and loose[i] < high else high
        ends.append(end)
        start = end
    if start < n:
        ends.append(n)
    return ends


def chunk_set(text: bytes) -> dict[bytes, int]:
    """Digest and length of every distinct chunk."""
    found, start = {}, 0
    for end in boundaries(np.frombuffer(text, np.uint8)):
        found[hashlib.blake2b(text[start:end], digest_size=DIGEST).digest()] = end - start
        start = end
    return found


def containment(one: dict[bytes, int], other: dict[bytes, int]) -> float:
    """Share of the bytes in the chunks of ``one`` that ``other`` has too. An empty set is contained in an empty one only."""
    if not one:
        return 0.0 if other else 1.0
    return sum(n for digest, n in one.items() if digest in other) / sum(one.values())


def rendered(chunks: dict[bytes, int]) -> str:
    """The fingerprint as text: digests in order, each with its length."""
    return " ".join(f"{digest.hex()}:{n:x}" for digest, n in sorted(chunks.items()))


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by as much of the next one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
FIELDS = [field.split()[0] for field in RESULT.split(", ")]


def _compared(doc_id, text: str, chunks: dict, following: str, next_chunks: dict) -> tuple:
    new = edited(text, following)
    new_chunks = chunk_set(new.encode())
    digest = hashlib.sha256(new.encode()).hexdigest()
    return (doc_id, len(text), digest, rendered(chunks), rendered(new_chunks), containment(chunks, new_chunks), containment(chunks, next_chunks))


def _batch(rows: list[tuple], edge: list[tuple]) -> pa.RecordBatch:
    """Finished rows, then the first and last text of a partition, which wait for their neighbours."""
    blank = (None,) * (len(FIELDS) - 1)
    both = [(*r, None, None, None) for r in rows] + [(doc_id, *blank, part, role, text) for doc_id, part, role, text in edge]
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_chars", pa.int64()), *[(c, pa.string()) for c in FIELDS[2:5]], ("near_edited", pa.float64()), ("near_next", pa.float64()), ("part", pa.int32()), ("role", pa.int32()), ("text", pa.string())]
    )
    columns = list(zip(*both)) if both else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One pass over a sorted partition: each text with the next; the first and the last go out as edges."""
    part, before = TaskContext.get().partitionId(), None
    for batch in batches:
        rows, edge = [], []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            now = (doc_id, text.as_py() or "", chunk_set((text.as_py() or "").encode()))
            if before:
                rows.append(_compared(*before, now[1], now[2]))
            else:
                edge.append((doc_id, part, 0, now[1]))
            before = now
        yield _batch(rows, edge)
    if before:
        yield _batch([], [(before[0], part, 1, before[1])])


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, text, following in zip(*(c.to_pylist() for c in batch.columns)):
            rows.append(_compared(doc_id, text, chunk_set(text.encode()), following, chunk_set(following.encode())))
        yield _batch(rows, []).select(FIELDS)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of every text, of its edited form, and how much of it the edited form and the next text contain.

    The next document is that of the next larger doc_id; after the last comes the first. Texts are range-sorted once, and
    a task walks its range in order; only the first and last text of each range meet their neighbours in a second,
    small step. Null texts are empty. Null doc_ids come first; rows that repeat a doc_id follow each other by hash of
    the text. A single document is its own next. Other columns are not read; an empty table gives an empty result.
    """
    ordered = docs.select("doc_id", "text").orderBy(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    walked = stage(ordered.mapInArrow(_walk, f"{RESULT}, part int, role int, text string"), "fingerprints")
    edges = walked.filter("role is not null").select("doc_id", "part", "role", "text")  # two rows per range
    heads = edges.filter("role = 0").select(F.col("part").alias("p"), F.col("text").alias("head"))
    order = W.orderBy("part")
    parts = edges.filter("role = 0").select("part", F.coalesce(F.lead("part").over(order), F.first("part").over(order)).alias("p"))
    tails = edges.filter("role = 1").join(parts, "part").join(heads, "p").select("doc_id", "text", "head")
    return walked.filter("role is null").select(*FIELDS).unionAll(tails.mapInArrow(_finish, RESULT))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents."""
    return fingerprints(table(spark, sf_dir, "documents"))
