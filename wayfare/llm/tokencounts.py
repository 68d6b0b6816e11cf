"""Token counts by section: encode a whole document once, then attribute its tokens by character spans.

Sections are the lines of a text, each with its line break. A document is encoded as a whole, so counts are those of
training, not of sections encoded alone. The bytes of byte-level tokens follow each other without a
gap: their running length gives every token's span, an interval join with the section spans says where it lies. A token
across a boundary belongs to the section that holds most of its characters, the earlier one on a tie.
"""

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from wayfare.llm.common import table
from wayfare.llm.textarrays import blocks

SECTIONS = "doc_id long, section long, start long, end long, n_tokens long, n_crossing long, doc_tokens long"
FIELDS = [field.split()[0] for field in SECTIONS.split(", ")]


def load_encoding(path: str):
    """A byte-level encoding from a file of ranks, and the byte length of each token."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    lengths = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        lengths[rank] = len(token)
    name = os.path.basename(path)
    return tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), lengths


def section_starts(raw: np.ndarray) -> np.ndarray:
    """Byte at which each section begins: the text's first, and after every line break but a last one."""
    breaks = np.flatnonzero(raw == 10) + 1
    return np.concatenate([[0], breaks[breaks < len(raw)]]).astype(np.int64)


def attribute(raw: np.ndarray, token_ends: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens and crossing tokens of each section, and character offsets of the section edges.

    ``token_ends`` are byte ends of the tokens of the whole text, ``starts`` byte starts of the sections. A token that holds only part of
    a character counts it as one where it begins.
    """
    edges = np.concatenate([starts, [len(raw)]])
    chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    token_starts = np.concatenate([[0], token_ends[:-1]]) if len(token_ends) else token_ends
    first = np.searchsorted(starts, token_starts, side="right") - 1
    last = np.searchsorted(starts, np.maximum(token_ends - 1, token_starts), side="right") - 1
    owner = first.copy()
    crossing = np.flatnonzero(first != last)
    for t in crossing.tolist():  # the few tokens over a boundary: characters in each section they touch
        touched = np.arange(first[t], last[t] + 1)
        low, high = np.maximum(edges[touched], token_starts[t]), np.minimum(edges[touched + 1], token_ends[t])
        owner[t] = touched[np.argmax(chars[high] - chars[low])]
    n = len(starts)
    return np.bincount(owner, minlength=n), np.bincount(owner[crossing], minlength=n), chars[edges]


def section_tokens(docs: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """A row per document and section: character span, tokens, tokens that crossed a boundary, and the document's tokens.

    A section's tokens add up to the document's. Null and empty texts are one empty section without tokens. Blank lines
    are sections too. Repeated rows and rows with a null doc_id are counted each. Texts are encoded whole, however long;
    strings of special tokens are ordinary text. Other columns are not read; an empty table gives an empty result.
    ``ranks_path`` defaults to the public byte-level vocabulary on the worker.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        encoding, lengths = load_encoding(ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"))
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for row, texts in blocks(batch.column(1)):
                columns: list[list] = [[] for _ in FIELDS]
                edges = texts.offsets.tolist()
                for i in range(len(texts)):
                    raw = texts.raw[edges[i] : edges[i + 1]]
                    tokens = np.array(encoding.encode_ordinary(raw.tobytes().decode()), np.int64)
                    starts = section_starts(raw)
                    counts, crossing, chars = attribute(raw, np.cumsum(lengths[tokens]), starts)
                    n = len(starts)
                    for column, values in zip(columns, (np.full(n, ids[row + i]) if ids[row + i] is not None else [None] * n, np.arange(n), chars[:-1], chars[1:], counts, crossing, np.full(n, len(tokens)))):
                        column.extend(values if isinstance(values, list) else values.tolist())
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], FIELDS)

    return docs.select("doc_id", "text").mapInArrow(work, SECTIONS)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every section of all documents."""
    return section_tokens(table(spark, sf_dir, "documents"))
