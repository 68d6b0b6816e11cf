"""Quality rules: an isolation forest on rule statistics, its threshold set from labelled rows.

Statistics are taken of every whole text. Each tree is grown on its own draw from all rows labelled good, as the method
has it; random splits isolate an odd document after few steps, so short mean paths mark anomalies. All labelled rows
are scored for the threshold, which keeps all but a small share of those labelled good. Scoring reads all documents.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm.common import filter_texts, ranked, stage, table
from wayfare.llm.rulestats import SCHEMA, STATS, rule_stats, text_stats
from wayfare.operators.selection import exact_quantiles

TREES = 100
SAMPLE = 256  # rows a tree is grown on
FIT_ROWS = 20_000  # good rows up to which the driver gets all of them; of more it gets those that trees draw
GOOD_LOST = 0.001  # share of rows labelled good that the threshold may reject
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20  # the base rules. Fixed values.
SEED = 11
FEATURES = ["symbols", "repeats", "word_length", "distinct", "stops"]
MARGIN = 0.5  # how far, in standard deviations, splits reach beyond the rows at hand
EXTRA_DEPTH = 6


def features(stats: np.ndarray) -> np.ndarray:
    """Rates of the rule statistics, one row per document; columns of ``stats`` in the order of STATS.

    Addresses, numbers and keys in a text are for other operators, so digits and long words play no part here.
    """
    s = {name: stats[:, i].astype(float) for i, name in enumerate(STATS)}
    words = np.maximum(s["n_words"], 1)
    # counts in short texts are noisy: pseudo-words keep one stray symbol from looking like a habit
    shrunk = lambda count: count / (words + 20)
    return np.stack(
        [
            shrunk(s["n_symbols"]),
            shrunk(s["n_repeat_words"]),
            np.log1p(s["word_chars"] / words),
            np.log1p(words) * (1 - s["n_distinct"] / words),
            shrunk(s["n_stops"]),
        ],
        axis=1,
    )


def _harmonic_path(n):
    """Mean path length of an unsuccessful search among n rows."""
    n = np.asarray(n, float)
    safe = np.maximum(n, 2)
    return np.where(n > 1, 2 * (np.log(np.maximum(safe - 1, 1)) + 0.5772156649015329) - 2 * (safe - 1) / safe, 0.0)


class Forest:
    """Isolation trees as flat arrays: feature (-1: leaf), split value, left child (right is next), path length.

    Trees grow on good rows; split values are drawn from a range ``MARGIN`` times ``scale`` wider than that of the rows
    at hand. A split beyond them has an empty side: a row that falls there is isolated at once, also
    by a feature in which all good rows agree.
    """

    def __init__(self, rows: np.ndarray, scale: np.ndarray, trees: int = TREES, sample: int = SAMPLE, seed: int = SEED, draws: list[np.ndarray] | None = None):
        """``draws`` holds the places in ``rows`` that each tree is grown on; without it every tree draws its own."""
        rng = np.random.default_rng(seed)
        self.sample = min(sample, len(rows)) if draws is None else len(draws[0])
        limit = math.ceil(math.log2(max(self.sample, 2))) + EXTRA_DEPTH
        able = np.flatnonzero(scale > 0)
        self.trees = []
        for tree in range(trees):
            picked = rows[rng.choice(len(rows), self.sample, replace=False) if draws is None else draws[tree]]
            feature, value, child, path = [-1], [0.0], [0], [0.0]
            todo = [(0, picked, 0)]
            while todo:
                node, here, depth = todo.pop()
                if depth >= limit or len(here) <= 1 or not len(able):
                    path[node] = depth + float(_harmonic_path(len(here)))
                    continue
                f = int(rng.choice(able))
                v = float(rng.uniform(here[:, f].min() - MARGIN * scale[f], here[:, f].max() + MARGIN * scale[f]))
                feature[node], value[node], child[node] = f, v, len(feature)
                for part in (here[here[:, f] < v], here[here[:, f] >= v]):
                    feature.append(-1), value.append(0.0), child.append(0), path.append(0.0)
                    todo.append((len(feature) - 1, part, depth + 1))
            self.trees.append((np.array(feature), np.array(value), np.array(child), np.array(path)))

    def score(self, rows: np.ndarray) -> np.ndarray:
        """2 to the minus mean path over its expectation: near 1 is an anomaly, 0.5 and less ordinary."""
        total, index = np.zeros(len(rows)), np.arange(len(rows))
        for feature, value, child, path in self.trees:
            node = np.zeros(len(rows), np.int64)
            while True:
                f = feature[node]
                inner = f >= 0
                if not inner.any():
                    break
                step = child[node] + (rows[index, np.maximum(f, 0)] >= value[node])
                node = np.where(inner, step, node)
            total += path[node]
        return 2.0 ** (-(total / len(self.trees)) / max(float(_harmonic_path(self.sample)), 1e-9))


def base_failed(n_words, n_repeat_words):
    return (n_words < MIN_WORDS) | (n_repeat_words * 100 > n_words * MAX_REPEAT_PERCENT)


def labelled_features(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, good and the FEATURES of every labelled document that passes the base rules.

    The worst label of a doc_id counts. Rows that share an id are one labelled document: the least row, statistics as a whole.
    """
    known = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    one = stats.filter("doc_id is not null").groupBy("doc_id").agg(F.min(F.struct(*STATS)).alias("of"))
    rows = one.join(known, "doc_id").select("doc_id", (F.col("quality") == 1).alias("good"), "of.*")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(np.stack([batch.column(c).to_numpy() for c in STATS], axis=1))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("good"), *[pa.array(c) for c in x.T]], ["doc_id", "good", *FEATURES])

    passed = rows.filter(~base_failed(F.col("n_words"), F.col("n_repeat_words")))
    return passed.mapInArrow(work, "doc_id long, good boolean, " + ", ".join(f"{c} double" for c in FEATURES))


def _features_of(rows: list) -> np.ndarray:
    return np.array([[r[c] for c in FEATURES] for r in rows], float).reshape(-1, len(FEATURES))


def grown(good: DataFrame, n: int, scale: np.ndarray, trees: int = TREES, sample: int = SAMPLE, seed: int = SEED) -> Forest:
    """A forest whose trees draw from all ``n`` good rows. No more than FIT_ROWS rows, or the ``trees`` times ``sample`` drawn, reach the driver."""
    if n <= FIT_ROWS:
        return Forest(_features_of(good.orderBy("doc_id").collect()), scale, trees, sample, seed)
    rng = np.random.default_rng(seed)
    draws = [rng.choice(n, min(sample, n), replace=False) for _ in range(trees)]
    ranks = np.unique(np.concatenate(draws))
    wanted = F.broadcast(good.sparkSession.createDataFrame(pa.table({"rank": ranks})))
    rows = ranked(good, F.col("doc_id")).join(wanted, "rank").orderBy("rank").collect()
    return Forest(_features_of(rows), scale, trees, sample, seed, [np.searchsorted(ranks, draw) for draw in draws])


def fit(docs: DataFrame, labels: DataFrame) -> tuple[Forest | None, float]:
    """``fit_stats`` of the documents' whole texts."""
    return fit_stats(stage(rule_stats(docs), "statistics"), labels)


def fit_stats(stats: DataFrame, labels: DataFrame) -> tuple[Forest | None, float]:
    """Forest and threshold from all labelled documents among ``stats``; without any, no forest and nothing is anomalous.

    The forest is grown on rows labelled good. The threshold is the score that all but GOOD_LOST of them stay below;
    where labelled bad rows all score higher still, it moves up half way towards them.
    """
    rows = stage(labelled_features(stats, labels), "labelled")
    n, *scale = rows.agg(F.count_if("good"), *[F.stddev_pop(c) for c in FEATURES]).first()
    if n < 2:
        return None, 1.0
    forest = grown(rows.filter("good"), n, np.array(scale))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch.column(c).to_numpy() for c in FEATURES], axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("good"), pa.array(forest.score(x))], ["good", "score"])

    scores = stage(rows.mapInArrow(work, "good boolean, score double"), "scores")
    threshold = exact_quantiles(scores.filter("good"), F.col("score"), [1 - GOOD_LOST])[0]
    above = exact_quantiles(scores.filter(~F.col("good") & (F.col("score") > threshold)), F.col("score"), [0.01])[0]
    if above is not None:
        threshold += 0.5 * max(0.0, above - threshold)
    return forest, threshold


def _verdict(stats: np.ndarray, forest: Forest | None, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base_failed, anomaly score and kept."""
    failed = base_failed(stats[:, STATS.index("n_words")], stats[:, STATS.index("n_repeat_words")])
    score = forest.score(features(stats)) if forest else np.zeros(len(stats))
    return failed, score, ~failed & (score <= threshold)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, rule statistics, base_failed, anomaly score and verdict of every document.

    Null and empty texts have no words and fail the base rules. Repeated rows are judged each; a
    row with a null doc_id like any other. Labels that are null, or of no document, teach nothing; the worst label of
    a doc_id counts. Without labels only the base rules reject. Other columns are not read. An empty table gives an empty result.
    """
    stats = stage(rule_stats(docs), "statistics")  # a few numbers a row: the texts are read once
    forest, threshold = fit_stats(stats, labels)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.stack([batch.column(c).to_numpy() for c in STATS], axis=1)
            columns = [pa.array(c) for c in _verdict(rows, forest, threshold)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "base_failed", "anomaly", "kept"])

    return stats.mapInArrow(work, f"{SCHEMA}, base_failed boolean, anomaly double, kept boolean")


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that ``judge`` keeps, with all their columns."""
    forest, threshold = fit(docs, labels)
    return filter_texts(docs, lambda texts: _verdict(np.stack(text_stats(texts), axis=1), forest, threshold)[2])


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule statistics and the forest's verdict on all documents."""
    judged = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "anomaly", "kept")
