"""Pack token streams into windows: order-preserving dynamic programming with a monotone queue.

Each input partition is one stream, packed in its stored order by the task that reads it: nothing is
shuffled, and a task holds a bounded run of the stream (``CHUNK`` tokens or one document). Cuts fall at document ends
for free, at sentence ends for a small penalty, and inside a long sentence for a large one; the
programme minimises padding plus penalties over all cuts of the run.
"""

import ctypes
import os
import re
import zlib
from array import array
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from wayfare.llm.common import table
from wayfare.llm.textarrays import blocks

WINDOW = 2048
END_ID = 1
CHUNK = 1 << 18
SENTENCE_PENALTY, INSIDE_PENALTY, SHORT_PENALTY = 8.0, 64.0, 48.0  # in tokens of padding
LONG_SENTENCE, INSIDE_STEP = 256, 64
SHORTEST = 64  # the least power of two that counts as a full window
CACHED_WORDS = 500_000
END = array("I", [END_ID]).tobytes()
PLAIN = re.compile("[a-z\u00e0-\u00f6\u00f8-\u00ff]+")
# byte-level vocabularies write a byte as the character of that number if it prints, else as the next one from 256 on
PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_CHARACTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in PRINTED)}
LATIN_END = re.compile(rb"\xc3[\xa0-\xb6\xb8-\xbf][.,]$")  # after a letter from a-grave to y-diaeresis
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def give_back() -> None:
    """Return freed memory to the system, where the C library has a call for it."""
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


class WordIds(dict):
    """Token ids of words (bytes to bytes of little-endian 32-bit ids), encoded on first use."""

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer = tokenizer

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHED_WORDS:
            self.clear()
        # a full stop or comma after a plain letter is a token of its own
        if word[-1:] in (b".", b",") and (word[-2:-1].isalnum() or LATIN_END.search(word)):
            ids = self[word[:-1]] + self[word[-1:]]
        elif PLAIN.fullmatch(text := word.decode()):
            # one piece that no rule changes: straight to the merges, as the characters that stand for its bytes
            pieces = self.tokenizer.model.tokenize(text if text.isascii() else word.decode("latin1").translate(BYTE_CHARACTERS))
            ids = array("I", [piece.id for piece in pieces]).tobytes()
        else:
            ids = array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        self[word] = ids
        return ids


class WordEncoder:
    """Token ids of texts by their words, remembered.

    The vocabulary's rules lower the case, drop white space and never join across it, so a text's ids are those of its
    words one after the other. A-Z are lowered first unless the text has combining marks, which
    the rules compose before they lower.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.known = WordIds(tokenizer)
        ends = [i for token, i in tokenizer.get_vocab().items() if token.endswith("</w>") and set(token[:-4]) <= set(".!?") and len(token) > 4]
        self.sentence_end = np.zeros(tokenizer.get_vocab_size(), bool)
        self.sentence_end[ends] = True

    def encode(self, raw: bytes) -> np.ndarray:
        """Ids of a UTF-8 text followed by the end id."""
        words = (raw if b"\xcc" in raw or b"\xcd" in raw else raw.lower()).split()
        return np.frombuffer(b"".join([*map(self.known.__getitem__, words), END]), "<u4")


def candidates(tokens: np.ndarray, ends: np.ndarray, sentence_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places where the stream may be cut, and the penalty of each. The first is 0, the last the stream's end."""
    penalty = np.full(len(tokens) + 1, np.inf)
    penalty[1:][sentence_end[np.minimum(tokens, len(sentence_end) - 1)]] = SENTENCE_PENALTY
    penalty[ends] = 0.0
    penalty[[0, len(tokens)]] = 0.0
    places = np.flatnonzero(np.isfinite(penalty))
    gaps = np.diff(places)
    wide = np.flatnonzero(gaps > LONG_SENTENCE)
    if len(wide):
        inside = np.concatenate([np.arange(places[i] + INSIDE_STEP, places[i + 1], INSIDE_STEP) for i in wide])
        penalty[inside] = INSIDE_PENALTY
        places = np.flatnonzero(np.isfinite(penalty))
    return places, penalty[places]


def cut_windows(places: np.ndarray, penalty: np.ndarray, window: int = WINDOW) -> list[int]:
    """The cheapest cuts from the first place to the last, windows of at most ``window`` tokens.

    cost(i) = penalty(i) + min over j of cost(j) + padding(i - j). Padding is window - length, so the
    minimum is that of cost(j) + place(j) over the last ``window`` tokens: a monotone queue. A window
    whose length is a power of two needs no padding; one shorter than ``window`` costs a fixed amount.
    """
    n = len(places)
    lengths = [window >> k for k in range(window.bit_length()) if window >> k >= SHORTEST]
    exact = []
    for length in lengths:
        at = np.searchsorted(places, places - length)
        hit = (at < n) & (places[np.minimum(at, n - 1)] == places - length)
        exact.append((0.0 if length == window else SHORT_PENALTY, np.where(hit, at, -1).tolist()))
    place, extra = places.tolist(), penalty.tolist()
    cost, parent = [0.0] * n, [0] * n
    queue: deque = deque([0])
    for i in range(1, n):
        here = place[i]
        while place[queue[0]] < here - window:
            queue.popleft()
        j = queue[0]
        best = cost[j] + place[j] + window - here
        for fee, at in exact:
            k = at[i]
            if k >= 0 and cost[k] + fee < best:
                best, j = cost[k] + fee, k
        cost[i], parent[i] = best + extra[i], j
        value = cost[i] + here
        while queue and cost[queue[-1]] + place[queue[-1]] >= value:
            queue.pop()
        queue.append(i)
    cuts, i = [place[-1]], n - 1
    while i:
        i = parent[i]
        cuts.append(place[i])
    return cuts[::-1]


class Stream:
    """The run of documents of one task that is not yet packed."""

    def __init__(self, sentence_end: np.ndarray, first_sequence: int, window: int = WINDOW):
        self.sentence_end, self.sequence, self.window = sentence_end, first_sequence, window
        self.parts: list[tuple] = []  # doc_id, ids left, ids before them, ids of the document
        self.held = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.parts.append((doc_id, ids, 0, len(ids)))
        self.held += len(ids)

    def flush(self, last: bool) -> list[tuple]:
        """Rows of the windows that are settled; before the end of the stream its last two windows stay open."""
        if not self.parts:
            return []
        tokens = np.concatenate([p[1] for p in self.parts])
        bounds = np.concatenate([[0], np.cumsum([len(p[1]) for p in self.parts])])
        cuts = cut_windows(*candidates(tokens, bounds[1:], self.sentence_end), self.window)
        if not last:
            cuts = cuts[: max(1, len(cuts) - 2)]
        settled = cuts[-1]
        edges = np.unique(np.concatenate([cuts, bounds[bounds <= settled]])).tolist()
        owner = np.searchsorted(bounds, edges[:-1], side="right") - 1
        window = np.searchsorted(cuts, edges[:-1], side="right") - 1
        raw, rows = tokens.tobytes(), []
        for start, end, d, w in zip(edges, edges[1:], owner.tolist(), window.tolist()):
            doc_id, _, before, total = self.parts[d]
            crc = zlib.crc32(raw[4 * start : 4 * end])
            rows.append((doc_id, int(before + start - bounds[d]), end - start, crc, total, self.sequence + w, start - cuts[w]))
        self.sequence += len(cuts) - 1
        kept = []
        for (doc_id, ids, before, total), start, end in zip(self.parts, bounds.tolist(), bounds[1:].tolist()):
            if end > settled:
                done = max(0, settled - start)
                kept.append((doc_id, ids[done:], before + done, total))
        self.parts, self.held = kept, len(tokens) - settled
        return rows


def pack(docs: DataFrame, tokenizer_path: str | None = None, window: int = WINDOW) -> DataFrame:
    """The pieces of every document in sequences of at most ``window`` tokens.

    A null or empty text is its end id alone. Repeated rows, and rows with a null doc_id, are packed
    each on their own. Texts of any length are packed whole: a document longer than a window spans
    several. Columns beyond doc_id and text are not read; an empty table gives no pieces. Sequence ids are unique,
    not consecutive: the reading task's number, then a count. ``tokenizer_path`` defaults to the
    public word vocabulary on the worker.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        encoder = WordEncoder(tokenizer_path or public_tokenizers.path("word_bpe_49k.json"))
        stream = Stream(encoder.sentence_end, TaskContext.get().partitionId() << 32, window)
        fields = [field.split()[0] for field in PIECES.split(", ")]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [[] for _ in fields]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], fields)

        for arrow in batches:
            ids = arrow.column(0).to_pylist()
            for row, texts in blocks(arrow.column(1)):
                edges = texts.offsets.tolist()
                for i in range(len(texts)):
                    stream.add(ids[row + i], encoder.encode(texts.raw[edges[i] : edges[i + 1]].tobytes()))
                    if stream.held >= CHUNK:
                        yield batch(stream.flush(last=False))
        yield batch(stream.flush(last=True))
        del encoder, stream  # a worker serves more tasks: the words and vocabulary of this one go before the next loads its own
        give_back()

    return docs.select("doc_id", "text").mapInArrow(work, PIECES)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2,048 tokens."""
    return pack(table(spark, sf_dir, "documents"))
