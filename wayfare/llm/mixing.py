"""Mix sources to target weights with repeated epochs, in DataFrame operations only.

Every document gets a hash-random key. Within its source, key order is the order in which the mix
takes documents. The cut is found by prefix sums of word counts down a radix tree of key ranges:
256 ranges a source, 4,096 ranges inside the one that holds the cut, then the documents of one such
range. What is left is one row per source (whole epochs, key of the cut), so taking is a comparison
per document: no text is shuffled and no source, however hot, is sorted in one task.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayfare.llm.common import WORD, ranked, stage, table

#: Weights dealt to the sources in order, again and again. Fixed values.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
KEY_SEED = "mix|"
RANGES = (2, 5)  # hex digits of a key that name its range on the first and second level
TEXT_RANGES = (34, 37)  # and, behind the 32 of the id, on two more, for an id that very many rows share


def _key(doc_id: Column, text: Column | None = None) -> Column:
    """Hash of the id; with ``text``, its hash behind it, which tells rows with a null or shared id apart and moves no others."""
    by_id = F.md5(F.concat(F.lit(KEY_SEED), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.concat(by_id, F.md5(F.coalesce(text, F.lit("")))) if text is not None else by_id


def sized(docs: DataFrame, by_text: bool = False) -> DataFrame:
    """doc_id, source, number of words, and the hash key of every document. Null text has no words."""
    key = _key(F.col("doc_id"), F.col("text") if by_text else None)
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    return docs.select("doc_id", "source", size.alias("size"), key.alias("key"))


def water_fill(sources: DataFrame, share: float, max_epochs: int) -> DataFrame:
    """Add ``target``: ``share`` of all words by weight, no source above ``max_epochs`` times its size.

    The excess of capped sources goes to the others by weight until none is above: the level (words
    per unit of weight) rises until it is steady. A pass is one aggregate of a row per source.
    """
    cap = F.col("source_size") * max_epochs
    total, weights = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    wanted = share * (total or 0)
    level, steady = (wanted / weights if weights else 0.0), False
    while not steady:
        capped = cap <= F.col("weight") * F.lit(level)
        held, rest = sources.agg(F.sum(F.when(capped, cap)), F.sum(F.when(~capped, F.col("weight")))).first()
        raised = (wanted - (held or 0)) / rest if rest else level
        steady, level = not rest or raised == level, raised
    by_weight = F.col("weight") * F.lit(level)
    return sources.withColumn("target", F.when(cap <= by_weight, cap.cast("double")).otherwise(by_weight))


def _cut_ranges(cells: DataFrame, plan: DataFrame, by: list[str], cell: str) -> DataFrame:
    """Per source, the cell of its range where the running word count passes ``rest``."""
    order = W.partitionBy(*by).orderBy(cell).rowsBetween(W.unboundedPreceding, -1)
    before = cells.withColumn("before", F.coalesce(F.sum("words").over(order), F.lit(0)))
    same = F.col("p.source").eqNullSafe(F.col("c.source"))
    found = before.alias("c").join(plan.alias("p"), same).filter(
        (F.col("c.before") < F.col("p.rest")) & (F.col("p.rest") <= F.col("c.before") + F.col("c.words"))
    )
    return found.select("p.source", F.col(f"c.{cell}").alias(cell), (F.col("p.rest") - F.col("c.before")).alias("rest"))


def plan_mix(sized_docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS, ranges: tuple = RANGES) -> DataFrame:
    """One row per source: size, weight, target, whole epochs, and the key at the cut.

    ``cut_key`` is the key of the document in which the budget ends, ``cut_words`` the words still
    taken of it and ``cut_size`` its size; all null where whole epochs meet the budget. Sources
    rank by code point, null last. Rows that share a doc_id share a key and count as one there.
    """
    sums = sized_docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = ranked(sums, F.col("source").asc_nulls_last(), name="place")
    dealt = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    filled = water_fill(stage(order.withColumn("weight", dealt), "sources"), share, max_epochs)
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("bigint")
    plan = filled.withColumn("epochs", epochs).withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
    plan = stage(plan.drop("place"), "plan")

    inside = sized_docs.filter(F.col("size") > 0)
    wanted = plan.filter(F.col("rest") > 0).select("source", "rest")
    for digits in ranges:
        inside = inside.withColumn("cell", F.substring("key", 1, digits))
        cells = inside.groupBy("source", "cell").agg(F.sum("size").alias("words"))
        found = stage(_cut_ranges(cells, wanted, ["source"], "cell"), "cut")
        inside, wanted = _semi(inside, found, "cell"), found.select("source", "rest")
    keys = inside.groupBy("source", "key").agg(F.sum("size").alias("words"))
    cut = _cut_ranges(keys, wanted, ["source"], "key")
    cut = cut.select(F.col("source").alias("cut_source"), F.col("key").alias("cut_key"), F.col("rest").alias("cut_words"))
    size = keys.select(F.col("source").alias("s"), F.col("key").alias("k"), F.col("words").alias("cut_size"))
    cut = cut.join(size, F.col("cut_source").eqNullSafe(F.col("s")) & (F.col("cut_key") == F.col("k"))).drop("s", "k")
    return stage(plan.join(cut, F.col("source").eqNullSafe(F.col("cut_source")), "left").drop("cut_source"), "mix")


def _semi(rows: DataFrame, found: DataFrame, cell: str) -> DataFrame:
    keys = found.select(F.col("source").alias("s"), F.col(cell).alias("c"))
    return rows.join(keys, F.col("source").eqNullSafe(F.col("s")) & (F.col(cell) == F.col("c")), "left_semi")


def _taken(size, key):
    """Words taken of a document: whole epochs, once more before the cut, and its part at the cut."""
    part = F.floor(F.col("cut_words") * size / F.col("cut_size"))
    once_more = F.when(key < F.col("cut_key"), size).when(key == F.col("cut_key"), part).otherwise(0)
    return (F.col("epochs") * size + once_more).cast("bigint")


def mix(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target and taken words of every document.

    A source's taken words add up to its target, rounded down; a document is taken at most
    ``max_epochs`` times. Null text and text without words have size 0 and nothing taken. Null
    sources are a source of their own. Repeated rows count each; rows that share a doc_id at the cut
    share what is left in proportion. Columns beyond doc_id, text and source are not read. An
    empty table gives an empty result. Reruns agree: the order is a hash of doc_id.
    """
    rows = stage(sized(docs), "sized")
    plan = plan_mix(rows, **options).withColumnRenamed("source", "of")
    joined = rows.join(plan, F.col("source").eqNullSafe(F.col("of")))
    return joined.select("doc_id", "size", "source_size", "target", _taken(F.col("size"), F.col("key")).alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as it is taken, with its own columns.

    The order is a hash of doc_id and text, so the cut falls on one text whatever the ids are; rows equal in both
    are at the cut together. The document at a source's cut is kept whole where at least half of it is taken. Documents without words are
    not taken. Columns of ``docs`` pass through whatever their names.
    """
    rows = stage(sized(docs, by_text=True), "sized")
    plan = plan_mix(rows, ranges=RANGES + TEXT_RANGES, **options).select("source", "epochs", "cut_key", "cut_words", "cut_size")
    row, by = F.struct(*[docs[c] for c in docs.columns]).alias("row"), plan.select(F.struct("*").alias("plan"))
    size = F.coalesce(F.regexp_count(F.col("row.text"), F.lit(WORD)), F.lit(0)).cast("bigint")
    key = _key(F.col("row.doc_id"), F.col("row.text"))
    joined = docs.select(row).join(by, F.col("row.source").eqNullSafe(F.col("plan.source")))
    joined = joined.select("row", size.alias("size"), key.alias("key"), "plan.*")
    copies = F.when(F.col("size") > 0, F.round(_taken(F.col("size"), F.col("key")) / F.col("size"))).otherwise(0).cast("int")
    repeated = joined.filter(copies > 0).select("row", F.explode(F.sequence(F.lit(1), copies)).alias("copy"))
    return repeated.select("row.*")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed at weights 5, 2, 1 with 150 % of their words."""
    return mix(table(spark, sf_dir, "documents"))


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS n FROM d GROUP BY source),
g AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM s),
o AS (
  SELECT *, 2 * n AS cap, sum(n) OVER () AS total,
         coalesce(sum(2 * n) OVER (ORDER BY 2.0 * n / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
         sum(w) OVER (ORDER BY 2.0 * n / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_w
  FROM g),
l AS (SELECT *, (1.5 * total::DOUBLE - held::DOUBLE) / open_w::DOUBLE AS level FROM o),
f AS (SELECT max(level) AS level FROM l WHERE cap > w * level),
t AS (
  SELECT source, n, CASE WHEN f.level IS NULL OR cap <= w * f.level THEN cap::DOUBLE ELSE w * f.level END AS target
  FROM l CROSS JOIN f),
e AS (
  SELECT d.doc_id, d.size, t.n, t.target,
         CASE WHEN t.n > 0 THEN CAST(floor(floor(t.target) / t.n) AS BIGINT) ELSE 0 END AS epochs,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, n AS source_size, target,
       CAST(epochs * size + least(greatest(floor(target) - epochs * n - before, 0), size) AS BIGINT) AS taken
FROM e
"""
