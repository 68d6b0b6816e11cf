"""Token-id files: ids in bit or byte planes, each plane compressed, with a chunk index.

A file holds a run of documents in ascending doc_id order as columns: the token ids end to end, the doc_ids, the lengths,
and flags of null doc_ids. Every column is cut into chunks of a fixed number of values. A chunk is transposed, so that plane k has byte
k (or bit k) of all its values in a row; high planes of small numbers are then runs of zeros, and each plane is compressed alone with
zstandard. The index at the end says for every chunk where it lies, which values it holds and the checksum of them, so any
run of documents is read without the rest of the file.

    magic | chunks ... | compressed index | its size, 8 bytes little-endian | magic
"""

import functools
import gc
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayfare import session
from wayfare.llm import blockfiles
from wayfare.llm.common import stage, table
from wayfare.llm.packing import BYTE_CHARACTERS
from wayfare.llm.textarrays import blocks

MAGIC = b"WFPLANE1"
END_ID = 0
CHUNK = 1 << 16  # values of a chunk
SEGMENT_IDS = 1 << 22  # ids, about, that one reading step takes
COLUMNS = {"ids": (0, "<u4"), "docs": (1, "<i8"), "lengths": (2, "<u8"), "nulls": (3, "u1")}
ENTRY = np.dtype([("column", "u1"), ("bits", "u1"), ("first", "<u8"), ("n", "<u4"), ("at", "<u8"), ("sizes", "<u4", (64,)), ("crc", "<u4")])
CACHED_WORDS = 400_000  # of each generation, some 70 MB
ALONE = re.compile(r" (?=\S)")  # a space before a visible character always begins a piece of its own
LINE = re.compile(r"(?<=\S)\n(?=\S)")  # and a single line break between visible characters is one
STOPS = {".", ","}  # signs that most often end a word
SHOWN = [chr(BYTE_CHARACTERS.get(b, b)) for b in range(256)]  # the character that stands for each byte
# runs that the rules tell apart: letters, digits, signs (no apostrophe, which may begin a piece of letters)
RUN = re.compile(r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+|[0-9]+|[!-&(-/:-@\[-`{-~]+")


# ---- planes


def to_planes(values: np.ndarray, bits: bool) -> list[bytes]:
    """Byte (or bit) k of every value, lowest first."""
    raw = values.view(np.uint8).reshape(len(values), values.itemsize)
    if not bits:
        return [np.ascontiguousarray(raw[:, k]).tobytes() for k in range(values.itemsize)]
    single = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(single[:, k], bitorder="little").tobytes() for k in range(single.shape[1])]


def from_planes(planes: list[bytes], n: int, dtype: str, bits: bool) -> np.ndarray:
    held = np.stack([np.frombuffer(p, np.uint8) for p in planes])
    if bits:
        single = np.unpackbits(held, axis=1, bitorder="little", count=n)
        held = np.packbits(single.T, axis=1, bitorder="little").T
    return np.ascontiguousarray(held.T).view(dtype).reshape(-1)


class Writer:
    """Columns of one file; a chunk goes out as soon as it is full."""

    def __init__(self, out, bits: bool = False, level: int = 3):
        self.out, self.bits, self.at = out, bits, len(MAGIC)
        self.packer = zstandard.ZstdCompressor(level=level)
        self.entries: list[tuple] = []
        self.held: dict[str, list[np.ndarray]] = {name: [] for name in COLUMNS}
        self.waiting = dict.fromkeys(COLUMNS, 0)
        self.written = dict.fromkeys(COLUMNS, 0)
        out.write(MAGIC)

    def add(self, name: str, values: np.ndarray) -> None:
        self.held[name].append(np.asarray(values).astype(COLUMNS[name][1]))
        self.waiting[name] += len(values)
        if self.waiting[name] >= CHUNK:
            self._flush(name, False)

    def _flush(self, name: str, last: bool) -> None:
        if not self.waiting[name]:
            return
        values = np.concatenate(self.held[name])
        whole = len(values) if last else len(values) // CHUNK * CHUNK
        for first in range(0, whole, CHUNK):
            self._chunk(name, values[first : min(first + CHUNK, whole)])
        self.held[name], self.waiting[name] = [values[whole:].copy()], len(values) - whole

    def _chunk(self, name: str, values: np.ndarray) -> None:
        planes = [self.packer.compress(p) if p.count(0) < len(p) else b"" for p in to_planes(values, self.bits)]  # an empty plane is all zeros
        sizes = np.zeros(64, "<u4")
        sizes[: len(planes)] = [len(p) for p in planes]
        self.out.write(b"".join(planes))
        self.entries.append((COLUMNS[name][0], self.bits, self.written[name], len(values), self.at, sizes, zlib.crc32(values.tobytes())))
        self.written[name] += len(values)
        self.at += int(sizes.sum())

    def close(self) -> None:
        for name in COLUMNS:
            self._flush(name, True)
        index = self.packer.compress(np.array(self.entries, ENTRY).tobytes())
        self.out.write(index + len(index).to_bytes(8, "little") + MAGIC)


class Reader:
    """Runs of values of one file, through its index."""

    def __init__(self, source):
        self.source, size = source, source.size()
        if source.read_at(len(MAGIC), 0) != MAGIC or source.read_at(len(MAGIC), size - len(MAGIC)) != MAGIC:
            raise ValueError("not a token-id file, or one cut short")
        self.unpacker = zstandard.ZstdDecompressor()
        length = int.from_bytes(source.read_at(8, size - len(MAGIC) - 8), "little")
        entries = np.frombuffer(self.unpacker.decompress(source.read_at(length, size - len(MAGIC) - 8 - length)), ENTRY)
        self.entries = {name: entries[entries["column"] == number] for name, (number, _) in COLUMNS.items()}

    def count(self, name: str) -> int:
        return int(self.entries[name]["n"].sum())

    def chunks(self, name: str, first: int, last: int) -> Iterator[np.ndarray]:
        """Values ``first`` to before ``last`` of a column, chunk by chunk; a chunk whose checksum differs is an error."""
        entries, dtype = self.entries[name], COLUMNS[name][1]
        at = int(np.searchsorted(entries["first"], first, side="right")) - 1
        while first < last:
            entry = entries[at]
            values = self._chunk(entry, dtype)
            start = int(entry["first"])
            yield values[first - start : last - start]
            first, at = start + int(entry["n"]), at + 1

    def values(self, name: str, first: int, last: int) -> np.ndarray:
        return np.concatenate([np.zeros(0, COLUMNS[name][1]), *self.chunks(name, first, last)])

    def _chunk(self, entry, dtype: str) -> np.ndarray:
        n, bits = int(entry["n"]), bool(entry["bits"])
        n_planes = np.dtype(dtype).itemsize * (8 if bits else 1)
        plane_bytes = -(-n // 8) if bits else n
        raw = self.source.read_at(int(entry["sizes"].sum()), int(entry["at"]))
        planes, at = [], 0
        for size in entry["sizes"][:n_planes].tolist():
            planes.append(self.unpacker.decompress(raw[at : at + size], max_output_size=plane_bytes) if size else bytes(plane_bytes))
            at += size
        values = from_planes(planes, n, dtype, bits)
        if zlib.crc32(values.tobytes()) != int(entry["crc"]):
            raise ValueError("a chunk of a token-id file is damaged")
        return values


# ---- encoding


class PieceIds(dict):
    """Token ids (bytes of little-endian 32-bit ids) of pieces of text, encoded on first use; ``lead`` comes before each.

    ``inner`` holds the pieces without a lead, for what follows the first run of a piece.
    """

    def __init__(self, tokenizer, lead: str, inner: "PieceIds | None" = None):
        super().__init__()
        self.encode, self.merge = tokenizer.encode, tokenizer.model.tokenize
        self.lead, self.mark = lead, lead.translate(BYTE_CHARACTERS)
        self.inner = self if inner is None else inner
        self.older: dict[str, bytes] = {}  # the generation before: words met again come back, the rest are forgotten

    def __missing__(self, piece: str) -> bytes:
        if (ids := self.older.get(piece)) is not None:
            self[piece] = ids
            return ids
        if len(self) >= CACHED_WORDS:
            self.older = dict(self)
            self.clear()
        if is_plain(piece):
            ids = self._merged(piece)
        elif piece[-1:] in STOPS and is_plain(piece[:-1]):
            ids = self[piece[:-1]] + self.inner[piece[-1]]
        else:
            runs = RUN.findall(piece)
            if len(runs) == 1 and len(runs[0]) == len(piece):
                ids = self._merged(piece)
            elif runs and sum(map(len, runs)) == len(piece):
                ids = self[runs[0]] + b"".join(map(self.inner.__getitem__, runs[1:]))
            else:
                ids = array("I", self.encode(self.lead + piece, add_special_tokens=False).ids).tobytes()
        if len(piece) < 64:
            self[piece] = ids
        return ids

    def _merged(self, run: str) -> bytes:
        """Ids of one run, which is one piece of the rules: straight to the merges, as the characters that stand for its bytes."""
        shown = run if run.isascii() else "".join([SHOWN[b] for b in run.encode()])
        return array("I", [token.id for token in self.merge(self.mark + shown)]).tobytes()


def is_plain(piece: str) -> bool:
    """Letters of the first 256 characters alone."""
    return piece.isalpha() and (piece.isascii() or max(piece) <= "\u00ff")


class Encoder:
    """Token ids of whole texts by their pieces, remembered.

    The vocabulary's rules never join across a space that stands before a visible character, nor across a line break between two, so
    the ids of a text are those of the pieces in between, one after the other. Strings of special tokens are ordinary text.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        self.first = PieceIds(tokenizer, "")
        self.later = PieceIds(tokenizer, " ", self.first)
        self.line_break = array("I", tokenizer.encode("\n", add_special_tokens=False).ids).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a text followed by the end id, as bytes."""
        found: list[bytes] = []
        for line in LINE.split(text) if text else ():
            pieces = line.split()
            if " ".join(pieces) != line:  # other white space than single spaces, or at an end
                pieces = ALONE.split(line)
            found += [self.line_break, self.first[pieces[0]] if line else b"", *map(self.later.__getitem__, pieces[1:])]
        return b"".join([*found[1:], array("I", [END_ID]).tobytes()])


@functools.lru_cache(maxsize=1)
def encoder_of(path: str) -> Encoder:
    """The encoder of a worker, which keeps its words from task to task."""
    return Encoder(path)


# ---- over Spark

SEGMENTS = "part int, uri string, first_doc long, n_docs long, first_id long, n_ids long"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
    fields = [field.split() for field in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields)], [name for name, _ in fields])


def write_token_files(docs: DataFrame, root: str, tokenizer_path: str | None = None, bits: bool = False, segment_ids: int = SEGMENT_IDS) -> DataFrame:
    """Encode the documents and write them to files below ``root`` in ascending order of doc_id.

    Texts are range-sorted once; each range becomes one file. Returns a staged row per segment of a file: which documents and
    ids it covers. Null texts are empty, an empty text is its end id alone. Null doc_ids come first; rows that repeat a doc_id follow each other
    by hash of the text, and equal rows are spread over as many files as their number asks for. Texts are encoded whole. Other columns are
    not read; an empty table gives no file. A repeated attempt of a task replaces its file by the same bytes.
    """
    root = blockfiles.as_uri(root)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("_row", F.monotonically_increasing_id())
    ordered = keyed.orderBy(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "_row").select("doc_id", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        part = TaskContext.get().partitionId()
        first = next((b for b in batches if len(b)), None)
        if first is None:
            return
        encoder = encoder_of(tokenizer_path or public_tokenizers.path("byte_bpe_50k.json"))
        uri = f"{root}/part-{part:06d}.planes"
        segments, docs_before, ids_before, n_docs, n_ids = [], 0, 0, 0, 0
        with blockfiles.replacing(uri) as out:
            writer = Writer(out, bits)
            batch = first
            gc.disable()  # encoding leaves no cycles, only many small objects to look through for them
            while batch is not None:
                writer.add("docs", batch.column(0).fill_null(0).to_numpy())
                writer.add("nulls", batch.column(0).is_null().to_numpy(zero_copy_only=False))
                for row, texts in blocks(batch.column(1)):
                    edges, lengths, held = texts.offsets.tolist(), [], []
                    data = texts.raw.tobytes()
                    for start, end in zip(edges, edges[1:]):
                        ids = encoder.encode(data[start:end].decode("utf-8", "replace"))
                        held.append(ids)
                        lengths.append(len(ids) // 4)
                    writer.add("ids", np.frombuffer(b"".join(held), "<u4"))
                    writer.add("lengths", np.array(lengths))
                    n_docs, n_ids = n_docs + len(lengths), n_ids + sum(lengths)
                    if n_ids >= segment_ids:
                        segments.append((part, uri, docs_before, n_docs, ids_before, n_ids))
                        docs_before, ids_before, n_docs, n_ids = docs_before + n_docs, ids_before + n_ids, 0, 0
                batch = next((b for b in batches if len(b)), None)
            gc.enable()
            writer.close()
        if n_docs:
            segments.append((part, uri, docs_before, n_docs, ids_before, n_ids))
        yield _batch(segments, SEGMENTS)

    return stage(ordered.mapInArrow(work, SEGMENTS), "token_files")


def read_documents(segments: DataFrame, ids: bool = False) -> DataFrame:
    """A row per document from its file: doc_id, tokens of all documents before it, its own, their checksum, and on request the ids.

    Each reading step takes the documents of one segment, chunk by chunk.
    """
    schema = DOCUMENTS + (", ids array<long>" if ids else "")
    # one row per file: what the files before it hold
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = segments.join(parts.select("part", before.alias("before")), "part").select("uri", "first_doc", "n_docs", "first_id", "n_ids", "before")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, first_doc, n_docs, first_id, n_ids, before in zip(*(c.to_pylist() for c in batch.columns)):
                with blockfiles.reading(uri) as source:
                    yield from _segment(Reader(source), first_doc, n_docs, first_id, n_ids, before)

    def _segment(reader: Reader, first_doc: int, n_docs: int, first_id: int, n_ids: int, before: int) -> Iterator[pa.RecordBatch]:
        chunks, at = reader.chunks("ids", first_id, first_id + n_ids), before + first_id
        held = np.zeros(0, "<u4")
        for first in range(first_doc, first_doc + n_docs, CHUNK):
            last = min(first + CHUNK, first_doc + n_docs)
            doc_ids, nulls = reader.values("docs", first, last).tolist(), reader.values("nulls", first, last).tolist()
            rows: list[tuple] = []
            for doc_id, null, n in zip(doc_ids, nulls, reader.values("lengths", first, last).tolist()):
                crc, left, found = 0, n, []
                while left:
                    if not len(held):
                        held = next(chunks)
                    taken, held = held[:left], held[left:]
                    crc = zlib.crc32(taken.tobytes(), crc)
                    left -= len(taken)
                    if ids:
                        found.append(taken)
                rows.append((None if null else doc_id, at, n, crc, *([np.concatenate(found).tolist()] if ids else [])))
                at += n
                if ids and len(rows) >= 64:
                    yield _documents(rows)
                    rows = []
            yield _documents(rows)

    def _documents(rows: list[tuple]) -> pa.RecordBatch:
        names = [field.split()[0] for field in schema.split(", ")]
        columns = list(zip(*rows)) if rows else [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.list_(pa.int64()) if name == "ids" else pa.int64()) for name, c in zip(names, columns)], names)

    return placed.repartition(max(1, min(segments.count(), 8192))).mapInArrow(work, schema)


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded, written as byte planes in ascending doc_id order, and read back."""
    written = write_token_files(table(spark, sf_dir, "documents"), session.scratch_path(spark, "token_ids"))
    return read_documents(written)
