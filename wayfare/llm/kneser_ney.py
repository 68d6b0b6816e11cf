"""Perplexity under an interpolated modified Kneser-Ney bigram model, counted in Spark from all training texts.

Three shuffles of packed runs build the model: words by hash range, bigrams by the range of their scrambled
key, and what the bigrams say about each word (as a context, as a continuation) by word range. Each shard ends as sorted
arrays in the shared folder. Workers memory-map them and look up sorted batches of keys; only the pages that are
met are read. Nothing is pruned, and the driver sees one row per shard.

Model: p(w | v) = max(c(vw) - D(c), 0) / c(v) + g(v) p(w), with D by count 1, 2 and 3 or more, p(w) likewise from the number of
distinct words before w, and the last share spread evenly over the known words and one unknown word. Order
two is the longest whose arrays and shuffles stay within four times the input on disk.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare import session
from wayfare.llm.common import crc_rest, stage, table
from wayfare.llm.counted import RUN, Arrays, Counter, merged_shards, runs, summed, write_array
from wayfare.llm.textarrays import Texts, blocks, mix64

FOLDS, HELD_OUT = 7, 2  # crc32 of the id: documents of this remainder are never learned from. Fixed values.
END = mix64(np.array([7], np.uint64))[0]  # the hash that stands for the end of a text
BLOCK = 1 << 22
LEAST_SHARDS = 16
SHARD_BYTES = 1 << 26  # of text, about, for each shard


@dataclass(frozen=True)
class Layout:
    """Where the model lies and how its shards add up."""

    root: str
    bits: int  # 2 ** bits shards
    word_shards: tuple  # words in each shard
    tokens: int
    pair_shards: tuple = ()
    fact_shards: tuple = ()
    discounts: tuple = ()  # of bigrams
    word_discounts: tuple = ()
    pair_types: int = 0
    word_classes: tuple = ()  # words with 1, 2, 3 or more distinct predecessors

    @property
    def words(self) -> int:
        return sum(self.word_shards)

    @property
    def fact_size(self) -> int:
        """Words of one range of the facts; the begin mark is one word more."""
        return -(-(self.words + 1) // (1 << self.bits))


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple:
    """Modified Kneser-Ney discounts from the counts of counts; plain ones where a small corpus has no sound estimate."""
    if n1 and n2 and n3 and n4:
        y = n1 / (n1 + 2 * n2)
        found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
        if all(0 < d < k for k, d in enumerate(found, 1)):
            return found
    return (0.5, 1.0, 1.5)


def discount_of(counts: np.ndarray, d: tuple) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(counts, 3)]


def token_stream(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, texts end to end with END after each, and where each text begins."""
    words = texts.words(lower=True)
    starts = words.bounds() + np.arange(len(texts) + 1)
    stream = np.full(starts[-1], END, np.uint64)
    last = np.zeros(len(stream), bool)
    last[starts[1:] - 1] = True
    stream[~last] = words.hashes
    return stream, starts


class WordIds:
    """Number and count of words by hash, from the memory-mapped shards."""

    def __init__(self, layout: Layout, arrays: Arrays):
        self.layout, self.arrays = layout, arrays
        self.offsets = np.concatenate([[0], np.cumsum(layout.word_shards)])

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place of each hash in the distinct ones, and their numbers (-1: unknown) and counts."""
        distinct, place = np.unique(hashes, return_inverse=True)
        ids, counts = np.full(len(distinct), -1, np.int64), np.zeros(len(distinct), np.int64)
        shard = (distinct >> np.uint64(64 - self.layout.bits)).astype(np.int64)
        for s, start, end in spans(shard):
            n = self.layout.word_shards[s]
            at, hit = located(self.arrays.get(f"words-{s}", np.uint64, n), distinct[start:end])
            ids[start:end] = np.where(hit, at + self.offsets[s], -1)
            counts[start:end] = np.where(hit, self.arrays.get(f"word-counts-{s}", np.int64, n)[at] if n else 0, 0)
        return place, ids, counts


def spans(shard: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs of equal values: value, start, end."""
    edges = np.concatenate([[0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]])
    return [(int(shard[a]), int(a), int(b)) for a, b in zip(edges, edges[1:]) if b > a]


def located(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of sorted wanted keys in sorted keys, and whether they are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _pairs(ids: np.ndarray, starts: np.ndarray, begin: int) -> np.ndarray:
    """Number of the token before each token; ``begin`` at the start of a text."""
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[starts[:-1]] = begin
    return before


def _shard(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int64)


def _count_words(bits: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter()
        for batch in batches:
            for _, texts in blocks(batch.column(0), BLOCK):
                counter.add(*np.unique(token_stream(texts)[0], return_counts=True))
        keys, counts = counter.merge()
        yield runs(keys, counts, _shard(keys, bits))

    return work


def _keep_words(root: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, keys, counts in merged_shards(batches):
            write_array(f"{root}/words-{shard}", keys)
            write_array(f"{root}/word-counts-{shard}", counts)
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([len(keys)]), pa.array([int(counts.sum())])], ["shard", "n", "tokens"])

    return work


def _count_pairs(layout: Layout):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter()
        with Arrays(layout.root) as arrays:
            words = WordIds(layout, arrays)
            for batch in batches:
                for _, texts in blocks(batch.column(0), BLOCK):
                    stream, starts = token_stream(texts)
                    place, ids, _ = words.find(stream)
                    after = ids[place]
                    key = (_pairs(after, starts, layout.words).astype(np.uint64) << np.uint64(32)) | after.astype(np.uint64)
                    counter.add(*np.unique(key, return_counts=True))
        keys, counts = counter.merge()
        yield runs(keys, counts, _shard(mix64(keys), layout.bits))

    return work


MOST_WORDS = 1 << 32  # two word numbers make one 64-bit key
FACTS = 5  # of a word: tokens after it; words seen after it once, twice, more often; words seen before it


def _keep_pairs(layout: Layout):
    """Write bigram shards; pass on facts about words, and counts of counts as a run of shard -1."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, keys, counts in merged_shards(batches):
            scrambled = mix64(keys)
            order = np.argsort(scrambled)
            write_array(f"{layout.root}/pairs-{shard}", scrambled[order])
            write_array(f"{layout.root}/pair-counts-{shard}", np.minimum(counts[order], 2**32 - 1).astype(np.uint32))
            before, after = keys >> np.uint64(32), keys & np.uint64(0xFFFFFFFF)
            facts = np.zeros((2 * len(keys), FACTS), np.int64)
            facts[: len(keys), 0] = counts
            facts[np.arange(len(keys)), np.minimum(counts, 3)] = 1
            facts[len(keys) :, 4] = 1
            word, facts = summed(np.concatenate([before, after]), facts)
            yield runs(word, facts, (word // np.uint64(layout.fact_size)).astype(np.int64))
            classes = np.array([[shard, len(keys), *[(counts == k).sum() for k in (1, 2, 3, 4)]]], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([shard], pa.int64()), pa.array([b""]), pa.array([classes.tobytes()])], ["shard", "n", "keys", "counts"])

    return work


def _keep_facts(layout: Layout):
    """Write what is known of each word of a range as dense arrays."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, word, facts in merged_shards(batches, FACTS):
            dense = np.zeros((layout.fact_size, FACTS), np.int64)
            dense[(word - np.uint64(shard * layout.fact_size)).astype(np.int64)] = facts
            d = np.array(layout.discounts)
            spare = (dense[:, 1:4] * d).sum(axis=1) / np.maximum(dense[:, 0], 1)
            write_array(f"{layout.root}/after-{shard}", dense[:, 0])
            write_array(f"{layout.root}/spare-{shard}", spare)
            write_array(f"{layout.root}/before-{shard}", dense[:, 4])
            classes = [int((dense[:, 4] == k).sum()) for k in (1, 2, 3, 4)] + [int((dense[:, 4] >= 3).sum())]
            names = ["shard", "n1", "n2", "n3", "n4", "n3up"]
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (shard, *classes)], names)

    return work


def train(docs: DataFrame) -> Layout:
    """Count all texts of ``docs`` and leave the model in the shared folder."""
    spark = docs.sparkSession
    root = session.scratch_path(spark, "bigrams")
    texts = docs.select("text")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(LEAST_SHARDS, size // SHARD_BYTES).bit_length()  # shards follow the data, so a shard's keys fit a task
    by_shard = lambda df: df.repartition("shard").sortWithinPartitions("shard")
    counted = by_shard(texts.mapInArrow(_count_words(bits), RUN)).mapInArrow(_keep_words(root), "shard int, n long, tokens long")
    found = {r.shard: r for r in stage(counted, "word_shards").collect()}  # a row per shard
    sizes = tuple(found[s].n if s in found else 0 for s in range(1 << bits))
    layout = Layout(root, bits, sizes, sum(r.tokens for r in found.values()))
    if not layout.tokens:
        return layout
    if layout.words >= MOST_WORDS:
        raise ValueError(f"{layout.words} distinct words; a bigram's key holds numbers below {MOST_WORDS}")
    kept = stage(by_shard(texts.mapInArrow(_count_pairs(layout), RUN)).mapInArrow(_keep_pairs(layout), RUN), "pair_shards")
    classes = {}
    for r in kept.filter("shard < 0").collect():  # a row per shard
        shard, *numbers = np.frombuffer(r["counts"], np.int64).tolist()
        classes[shard] = numbers
    totals = np.sum(list(classes.values()), axis=0).tolist()
    pair_sizes = tuple(classes[s][0] if s in classes else 0 for s in range(1 << bits))
    layout = Layout(root, bits, sizes, layout.tokens, pair_sizes, (), discounts(*totals[1:]), (), totals[0])
    facts = stage(by_shard(kept.filter("shard >= 0")).mapInArrow(_keep_facts(layout), "shard long, n1 long, n2 long, n3 long, n4 long, n3up long"), "fact_shards").collect()
    n1, n2, n3, n4, more = (sum(r[c] for r in facts) for c in ("n1", "n2", "n3", "n4", "n3up"))
    present = {r.shard for r in facts}
    return Layout(
        root, bits, sizes, layout.tokens, pair_sizes, tuple(s in present for s in range(1 << bits)), layout.discounts, discounts(n1, n2, n3, n4), totals[0], (n1, n2, more)
    )


class Scorer:
    """Log10 probabilities of token streams under the memory-mapped model."""

    def __init__(self, layout: Layout, arrays: Arrays):
        self.layout, self.arrays, self.words = layout, arrays, WordIds(layout, arrays)
        if layout.tokens:
            spare = sum(n * d for n, d in zip(layout.word_classes, layout.word_discounts)) / layout.pair_types
            self.even = spare / (layout.words + 1)

    def _facts(self, name: str, ids: np.ndarray, dtype) -> np.ndarray:
        """A fact of each of the sorted word numbers; 0 of those below 0."""
        found, size = np.zeros(len(ids), dtype), self.layout.fact_size
        for s, start, end in spans(np.maximum(ids, -1) // size):
            if s >= 0 and self.layout.fact_shards[s]:
                found[start:end] = self.arrays.get(f"{name}-{s}", dtype, size)[ids[start:end] - s * size]
        return found

    def _pair_counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts of bigram keys."""
        scrambled, place = np.unique(mix64(keys), return_inverse=True)
        found = np.zeros(len(scrambled), np.int64)
        for s, start, end in spans(_shard(scrambled, self.layout.bits)):
            n = self.layout.pair_shards[s]
            at, hit = located(self.arrays.get(f"pairs-{s}", np.uint64, n), scrambled[start:end])
            if n:
                found[start:end] = np.where(hit, self.arrays.get(f"pair-counts-{s}", np.uint32, n)[at], 0)
        return found[place]

    def score(self, texts: Texts) -> tuple[np.ndarray, ...]:
        """Per text: tokens, known tokens, base score, model score."""
        layout = self.layout
        stream, starts = token_stream(texts)
        place, ids, counts = self.words.find(stream)
        n_tokens = np.diff(starts)
        n_known = np.add.reduceat((counts[place] > 0).astype(np.int64), starts[:-1])
        base = np.log10((counts + 1) / (layout.tokens + layout.words + 1))[place]
        if not layout.tokens:
            return n_tokens, n_known, np.add.reduceat(base, starts[:-1]), np.add.reduceat(base, starts[:-1])
        order = np.argsort(ids)
        sorted_ids = ids[order]
        by_word = {}
        for name, dtype in (("before", np.int64), ("after", np.int64), ("spare", np.float64)):
            by_word[name] = np.empty(len(ids), dtype)
            by_word[name][order] = self._facts(name, sorted_ids, dtype)
        cont = by_word["before"]
        alone = (cont - discount_of(cont, layout.word_discounts)) / layout.pair_types + self.even
        begin = np.array([layout.words])
        begin_after, begin_spare = self._facts("after", begin, np.int64)[0], self._facts("spare", begin, np.float64)[0]
        before = _pairs(place, starts, -1)
        total = np.where(before < 0, begin_after, by_word["after"][before])
        spare = np.where(before < 0, begin_spare, by_word["spare"][before])
        context = np.where(before < 0, layout.words, ids[before])
        after = ids[place]
        pair = np.zeros(len(stream), np.int64)
        whole = np.flatnonzero((context >= 0) & (after >= 0) & (total > 0))
        key = (context[whole].astype(np.uint64) << np.uint64(32)) | after[whole].astype(np.uint64)
        pair[whole] = self._pair_counts(key)
        p = np.where(total > 0, (pair - discount_of(pair, layout.discounts)) / np.maximum(total, 1) + spare * alone[place], alone[place])
        return n_tokens, n_known, np.add.reduceat(base, starts[:-1]), np.add.reduceat(np.log10(p), starts[:-1])


def score_texts(docs: DataFrame, layout: Layout) -> DataFrame:
    """doc_id, held_out and the scores of every text of ``docs`` (doc_id, held_out, text)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with Arrays(layout.root) as arrays:
            scorer = Scorer(layout, arrays)
            for batch in batches:
                for row, texts in blocks(batch.column(2), BLOCK):
                    tokens, known, base, score = scorer.score(texts)
                    n = len(texts)
                    columns = [batch.column(0).slice(row, n), batch.column(1).slice(row, n), pa.array(tokens), pa.array(known), pa.array(np.full(n, layout.tokens)), pa.array(base), pa.array(score)]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return docs.select("doc_id", "held_out", "text").mapInArrow(work, schema)


def lm_scores(docs: DataFrame) -> DataFrame:
    """Scores of all texts under a model of those outside the held-out fold, with the perplexity per token.

    Null and empty texts are their end token alone. Repeated rows count and are scored each; a null doc_id is
    dealt by crc32 of empty text. Unknown words share one probability. Without training texts both scores are the base
    score. Other columns are not read; texts of any length count whole; an empty table gives an empty result.
    """
    held_out = crc_rest(F.col("doc_id"), FOLDS) == HELD_OUT
    layout = train(docs.filter(~held_out))
    scored = score_texts(docs.select("doc_id", held_out.alias("held_out"), "text"), layout)
    return scored.withColumn("perplexity", F.exp(-F.col("score") * math.log(10) / F.col("n_tokens")))


def op1_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents."""
    return lm_scores(table(spark, sf_dir, "documents"))
