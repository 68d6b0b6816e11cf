"""Statistics of quality rules over whole texts, for many texts at once."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wayfare.llm.textarrays import BYTE_VALUES, Texts, blocks, mix64, spans_hash

#: Characters counted as symbols. Fixed values.
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
STOPS = np.isin(np.arange(256), np.frombuffer(b".!?", np.uint8))
UPPERS = np.isin(np.arange(256), np.arange(65, 91))
DIGITS = np.isin(np.arange(256), np.arange(48, 58))
RUN = 5
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars", "n_lines", "n_distinct", "n_upper", "n_digits", "n_stops", "longest"]
SCHEMA = "doc_id long, " + ", ".join(f"{name} long" for name in STATS)


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set between consecutive offsets."""
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _doubles(hashes: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flags of entries whose hash occurs again within the same owner: any such, and those after the first."""
    key = mix64(hashes ^ mix64(owners.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    any_, later = np.zeros(len(key), bool), np.zeros(len(key), bool)
    any_[order[1:]] |= same
    any_[order[:-1]] |= same
    later[order[1:]] = same
    return any_, later


def text_stats(texts: Texts) -> list[np.ndarray]:
    """The columns of STATS, one entry per text."""
    raw, offsets, n = texts.raw, texts.offsets, len(texts)
    words = texts.words(lower=False)
    bounds = words.bounds()
    owners = np.repeat(np.arange(n), words.counts)
    chars = (raw & 0xC0) != 0x80
    char_sums = np.concatenate([[0], np.cumsum(chars, dtype=np.int64)])
    word_chars = char_sums[words.ends] - char_sums[words.starts]
    word_sums = np.concatenate([[0], np.cumsum(word_chars)])

    windows, first = words.windows(RUN)
    repeated, _ = _doubles(windows, owners[first])
    steps = np.zeros(len(owners) + 1, np.int64)
    np.add.at(steps, first[repeated], 1)
    np.add.at(steps, first[repeated] + RUN, -1)
    covered = np.cumsum(steps[:-1]) > 0 if len(owners) else np.zeros(0, bool)

    breaks = np.flatnonzero(raw == 10)
    line_starts = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    line_starts = line_starts[line_starts < len(raw)]
    line_owner = np.searchsorted(offsets, line_starts, side="right") - 1
    line_ends = np.minimum(np.concatenate([line_starts[1:], [len(raw)]]), offsets[line_owner + 1]) if len(line_starts) else line_starts
    closed = raw[line_ends - 1] == 10 if len(line_starts) else np.zeros(0, bool)
    line_ends = line_ends - closed
    has_word = np.searchsorted(words.starts, line_ends) > np.searchsorted(words.starts, line_starts)
    line_starts, line_ends, line_owner = line_starts[has_word], line_ends[has_word], line_owner[has_word]
    _, again = _doubles(spans_hash(BYTE_VALUES[raw], line_starts, line_ends), line_owner)
    _, known = _doubles(words.hashes, owners)
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, owners, word_chars)
    return [
        words.counts,
        word_sums[bounds[1:]] - word_sums[bounds[:-1]],
        _per_text(SYMBOLS[raw], offsets),
        np.bincount(line_owner[again], minlength=n),
        np.bincount(owners[covered], minlength=n),
        _per_text(chars, offsets),
        np.bincount(line_owner, minlength=n),
        words.counts - np.bincount(owners[known], minlength=n),
        _per_text(UPPERS[raw], offsets),
        _per_text(DIGITS[raw], offsets),
        _per_text(STOPS[raw], offsets),
        longest,
    ]


def rule_stats(docs: DataFrame) -> DataFrame:
    """doc_id and the STATS of every document's whole text. Null is an empty text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, texts in blocks(batch.column(1)):
                columns = [pa.array(c.astype(np.int64)) for c in text_stats(texts)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(texts)), *columns], ["doc_id", *STATS])

    return docs.select("doc_id", "text").mapInArrow(work, SCHEMA)
