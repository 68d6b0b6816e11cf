"""Hard negatives by slot-decomposed selection.

A positive of score s asks for the best negatives between two shares of s, so an anchor's windows overlap. Their upper limits,
in falling order, cut the scores into disjoint slots. Every task keeps the best few negatives of each slot for each anchor, a
grouped limit merges them before and after the one shuffle, and merging the slots from the lowest up
gives the best of all scores at or under each limit: one answer per window, each score compared once.

Anchors and rows are packed into blocks in the shared folder; a task multiplies pairs of blocks. What a task holds is two
blocks and one strip of their product, whatever the tables' sizes and however many rows share a label.
"""

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayfare import session
from wayfare.llm import blockfiles
from wayfare.llm.common import stage, table

POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95  # a negative's score in hundredths of the positive's
ROW_BYTES, ANCHOR_BYTES = 1 << 22, 1 << 20  # of the vectors of a block
STRIP = 1 << 20  # scores held at once
UNIT = 16  # anchor blocks that one task takes to a row block
MOST_TASKS = 8192
NO_ID = np.iinfo(np.int64).max  # stands for a null id, so that it comes last among ties
NONE = np.iinfo(np.int64).min


def is_usable(vector: Column) -> Column:
    """The vector is not null, and neither is an entry, and all are finite."""
    infinite = F.lit(float("inf"))
    sound = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < infinite))
    return vector.isNotNull() & F.coalesce(sound, F.lit(False))


def whole(vector: Column, scale: int) -> Column:
    """floor(scale * entry) of every entry taken as a double."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * scale))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), d)


def pack_blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
    """Write the rows (key, vec_id, label, x, limits) as blocks of at most ``size`` vectors of one length, ids ascending.

    Returns a staged row per block: its uri, number of vectors and their length.
    """
    root = blockfiles.as_uri(session.scratch_path(rows.sparkSession, name))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0

        def write(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            nonlocal made
            lines = pa.Table.from_batches(held)
            lengths = pc.list_value_length(lines.column("x")).to_numpy()
            found = []
            for d in np.unique(lengths).tolist():
                same = lines.filter(pa.array(lengths == d)).combine_chunks()
                ids = same.column("vec_id").fill_null(NO_ID).to_numpy()
                order = np.argsort(ids, kind="stable")
                uri = f"{root}/{part:06d}-{made:06d}.npz"
                made += 1
                blockfiles.write_arrays(
                    uri,
                    key=same.column("key").to_numpy()[order],
                    ids=ids[order],
                    labels=same.column("label").to_numpy()[order],
                    x=_matrix(same.column("x").combine_chunks(), d)[order],
                    limits=_matrix(same.column("limits").combine_chunks(), -1)[order] if len(same) else np.zeros((0, 0)),
                )
                found.append((uri, len(same), d))
            return pa.RecordBatch.from_pylist([{"uri": u, "n": n, "d": d} for u, n, d in found], pa.schema([("uri", pa.string()), ("n", pa.int64()), ("d", pa.int32())]))

        held, n = [], 0
        for batch in batches:
            while len(batch):
                taken = batch.slice(0, size - n)
                batch = batch.slice(len(taken))
                held.append(taken)
                n += len(taken)
                if n == size:
                    yield write(held)
                    held, n = [], 0
        if held:
            yield write(held)

    picked = rows.select("key", "vec_id", F.col("label").cast("long").alias("label"), "x", "limits")
    return stage(picked.mapInArrow(work, "uri string, n long, d int"), f"{name}_list")


def in_blocks(n: int, size: int) -> int:
    return max(1, -(-n // size))


def exact_scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of whole-number vectors, exact; an error where one may not fit 64 bits."""
    largest = float(np.abs(anchors.astype(float)).max(initial=0)) * float(np.abs(rows.astype(float)).max(initial=0)) * max(1, rows.shape[1])
    if largest < 2**53:
        return (anchors.astype(float) @ rows.T.astype(float)).astype(np.int64)
    if largest < 2**62:
        return anchors @ rows.T
    raise ValueError("inner products of these vectors may not fit 64 bits")


def best(scores: np.ndarray, wanted: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the k highest wanted scores of each row; among equals the lower column. In no order."""
    n = scores.shape[1]
    k = min(k, n)
    if not scores.size:
        return np.zeros(0, int), np.zeros(0, int)
    if int(np.abs(scores).max()) < 2**62 // n:
        place = np.where(wanted, scores * n + (n - 1 - np.arange(n)), NONE)
        found = np.argpartition(place, n - k, axis=1)[:, n - k :]
    else:
        order = np.stack([np.lexsort((np.arange(n), -line, ~w)) for line, w in zip(scores, wanted)])
        found = order[:, :k]
    rows = np.repeat(np.arange(len(scores)), k)
    columns = found.reshape(-1)
    kept = wanted[rows, columns]
    return rows[kept], columns[kept]


def block_pairs(anchors: DataFrame, rows: DataFrame) -> DataFrame:
    """Each row block with every group of UNIT anchor blocks, dealt over tasks. Only names of blocks are paired here."""
    numbered = F.row_number().over(W.orderBy("uri")) - 1
    units = anchors.withColumn("unit", F.floor(numbered / UNIT)).groupBy("unit").agg(F.collect_list(F.struct("uri", "d")).alias("anchors"))
    n_units, n_rows = units.count(), rows.count()
    deals = max(1, min(n_rows, 64))
    dealt = units.withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(deals - 1))))
    pairs = rows.withColumn("deal", F.pmod(numbered, F.lit(deals))).join(dealt, "deal").select("uri", "d", "anchors")
    return pairs.repartition(max(1, min(n_units * n_rows, MOST_TASKS)))


def over_pairs(pairs: DataFrame, compare: Callable, schema: str) -> DataFrame:
    """What ``compare(anchors, scores, rows)`` gives for every strip of the product of every pair of blocks, as columns."""
    fields = [field.split()[0] for field in schema.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, d, units in zip(*(batch.column(i).to_pylist() for i in range(3))):
                rows = None
                for unit in units:
                    if unit["d"] != d:
                        continue  # vectors of different lengths have no inner product
                    rows = rows or blockfiles.read_arrays(uri)
                    anchors = blockfiles.read_arrays(unit["uri"])
                    strip = max(1, STRIP // max(1, len(rows["ids"])))
                    for first in range(0, len(anchors["ids"]), strip):
                        cut = {name: values[first : first + strip] for name, values in anchors.items()}
                        columns = compare(cut, exact_scores(cut["x"], rows["x"]), rows)
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], fields)

    return pairs.mapInArrow(work, schema)


def _positives(anchors: dict, scores: np.ndarray, rows: dict, k: int):
    same = (anchors["labels"][:, None] == rows["labels"]) & (anchors["ids"][:, None] != rows["ids"])
    a, r = best(scores, same, k)
    return anchors["key"][a], scores[a, r], rows["ids"][r]


def _negatives(anchors: dict, scores: np.ndarray, rows: dict, k: int):
    """The k best of other labels in each slot: slot i holds scores at or under limit i and above limit i + 1."""
    other = anchors["labels"][:, None] != rows["labels"]
    uppers, least = anchors["limits"][:, :-1], anchors["limits"][:, -1:]
    other &= scores >= least
    found = []
    for i in range(uppers.shape[1]):
        inside = other & (scores <= uppers[:, i : i + 1])
        if i + 1 < uppers.shape[1]:
            inside &= scores > uppers[:, i + 1 : i + 2]
        a, r = best(scores, inside, k)
        found.append((anchors["key"][a], np.full(len(a), i), scores[a, r], rows["ids"][r]))
    return [np.concatenate(parts) for parts in zip(*found)]


def best_of(found: DataFrame, k: int, *keys: str) -> DataFrame:
    """The k first rows of every group, highest score first, then the smaller id, with their place from 1.

    Spark limits each group in the tasks before the shuffle, and again after it; no group is gathered.
    """
    order = W.partitionBy(*keys).orderBy(F.col("score").desc(), "id")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def hundredths(share: int, up: bool) -> Column:
    """share / 100 of the column ``score`` as the next whole number down or up, without leaving whole numbers."""
    product = f"score * {share}"
    return F.expr(f"({product} - pmod({product}, 100)) div 100 + {f'if(pmod({product}, 100) > 0, 1, 0)' if up else 0}").cast("long")


def mine(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """Hard negatives of every anchor and positive. ``rows`` holds vec_id, label and x (whole numbers), none null but vec_id.

    An anchor's positives are its ``positives`` best rows of the same label under another id; a positive's negatives are
    the ``negatives`` best rows of other labels with low * score <= 100 * negative score <= high * score. Best: highest
    inner product with the anchor, then smaller id, null ids last. Every row counts on its own, repeated ones too; a repeated anchor row
    is answered as often as it occurs. Positives without a negative in the window give no row: so do all with a negative score.
    Vectors of different lengths don't meet. Empty tables give an empty result.
    """
    spark = rows.sparkSession
    rows = rows.select("vec_id", "label", "x")
    n, longest = rows.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    row_block, anchor_block = (max(1, size // (8 * max(1, longest or 0))) for size in (ROW_BYTES, ANCHOR_BYTES))
    none = F.array().cast("array<long>")
    alone = rows.select(F.lit(0).cast("long").alias("key"), "*", none.alias("limits"))
    packed = pack_blocks(alone.repartition(in_blocks(n, row_block)), row_block, "rows")
    anchors = stage(rows.filter(is_anchor).withColumn("key", F.monotonically_increasing_id()), "anchors")
    n_blocks = in_blocks(anchors.count(), anchor_block)

    def blocks_of(lines: DataFrame, name: str) -> DataFrame:
        return pack_blocks(lines.repartition(n_blocks), anchor_block, name)

    first = block_pairs(blocks_of(anchors.withColumn("limits", none), "anchors_alone"), packed)
    matched = over_pairs(first, functools.partial(_positives, k=positives), "key long, score long, id long")
    chosen = stage(best_of(matched, positives, "key"), "positives")

    windows = chosen.select("key", "place", "score", "id", hundredths(high, up=False).alias("upper"), hundredths(low, up=True).alias("least"))
    # positives in order, so limits fall; an anchor with fewer repeats its last limit, whose further slots stay empty
    held = windows.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("place", "upper"))).alias("u"), F.min("least").alias("least"))
    limits = [F.get(F.col("u"), F.least(F.lit(i), F.size("u") - 1))["upper"] for i in range(positives)]
    limited = anchors.join(held.select("key", F.array(*limits, F.col("least")).alias("limits")), "key")
    second = block_pairs(blocks_of(limited, "anchors_limited"), packed)
    slots = best_of(over_pairs(second, functools.partial(_negatives, k=negatives), "key long, slot long, score long, id long"), negatives, "key", "slot")

    entry = F.struct((-F.col("score")).alias("minus"), "id")
    by_slot = [F.collect_list(F.when(F.col("slot") == i, entry)).alias(f"slot{i}") for i in range(positives)]  # at most ``negatives`` each
    gathered = slots.groupBy("key").agg(*by_slot)
    suffixes, merged = [], None
    for i in reversed(range(positives)):  # the lowest slot first: each step adds the next slot above
        merged = F.slice(F.sort_array(F.concat(merged, f"slot{i}") if merged is not None else F.col(f"slot{i}")), 1, negatives)
        suffixes.insert(0, merged)
    answers = gathered.select("key", F.posexplode(F.array(*suffixes)).alias("at", "top")).withColumn("place", F.col("at") + 1)
    joined = windows.join(answers.select("key", "place", "top"), ["key", "place"]).join(anchors.select("key", "vec_id"), "key")
    inside = F.filter("top", lambda e: -e["minus"] >= F.col("least"))
    listed = joined.select("vec_id", "id", "score", F.posexplode(inside).alias("at", "negative"))

    def real(column: Column) -> Column:
        return F.nullif(column, F.lit(int(NO_ID)))

    return listed.select(
        F.col("vec_id").alias("anchor_id"),
        real(F.col("id")).alias("positive_id"),
        (F.col("at") + 1).cast("int").alias("rank"),
        real(F.col("negative.id")).alias("negative_id"),
        F.col("score").alias("positive_score"),
        (-F.col("negative.minus")).alias("negative_score"),
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives from all embeddings.

    Rows without a label, or whose vector is null or has a null or non-finite entry, take no part. Where vec_id is divisible by
    7 the label is the next one; entries count as floor(256 * entry). Anchors are the rows whose vec_id is divisible by 50.
    """
    rows = table(spark, sf_dir, "embeddings").filter(F.col("label").isNotNull() & is_usable(F.col("embedding")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.select("vec_id", label.alias("label"), whole(F.col("embedding"), 256).alias("x")), F.col("vec_id") % 50 == 0)


OP12_SQL = """
WITH taken AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0),
anchors AS (SELECT row_number() OVER () AS k, * FROM taken WHERE vec_id % 50 = 0),
scores AS (
  SELECT a.k, a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_inner_product(a.x, r.x)::BIGINT AS score
  FROM anchors a JOIN taken r ON a.label <> r.label OR a.vec_id <> r.vec_id),
positives AS (
  SELECT k, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY k ORDER BY score DESC, vec_id) AS place
  FROM scores WHERE same QUALIFY place <= 5),
answers AS (
  SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.k, p.place ORDER BY s.score DESC, s.vec_id) AS place
  FROM positives p JOIN scores s ON s.k = p.k AND NOT s.same AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, place::INTEGER AS rank, negative_id, positive_score, negative_score FROM answers WHERE place <= 3
"""
