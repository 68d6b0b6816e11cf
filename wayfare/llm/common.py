"""Helpers shared by the training-data operators: tables, scratch stages, distributed ranks, filters by text."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from wayfare import session
from wayfare.llm.textarrays import blocks

#: A word: a run of anything but the six ASCII white-space characters. Fixed value.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A to Z as a to z; every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def crc_rest(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``: a fixed deal of documents into folds. A null id is dealt as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def stage(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared scratch folder and read back: lineage ends here, lost executors cost a reread."""
    path = session.scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Hand texts to Python workers in batches of ``rows`` rows, unless the session sets a number of its own.

    Batches only bound what a worker and its executor hold at once; results don't depend on them. The setting stays
    with the session, as plans read it when they run.
    """
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def ranked(df: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """Add the 0-based position of every row in the given order, without gathering the rows.

    Rows are range-sorted once and written with their place inside their partition; the places of
    earlier partitions add up to an offset. That sum has one row per partition.
    """
    placed = stage(df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()), "ranked")
    part, place = F.shiftright("_place", 33), F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    parts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    offsets = parts.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    joined = placed.withColumn("_part", part).join(offsets, "_part")
    return joined.withColumn(name, F.col("_before") + place).drop("_part", "_place", "_before")


def filter_texts(docs: DataFrame, decide) -> DataFrame:
    """The rows whose text ``decide`` (texts to an array of flags) is true for. Columns pass through unchanged, whatever their names."""
    place = docs.columns.index("text")

    def work(batches):
        for batch in batches:
            flags = [np.asarray(decide(texts), bool) for _, texts in blocks(batch.column(place))]
            yield batch.filter(pa.array(np.concatenate(flags))) if flags else batch

    return docs.mapInArrow(work, docs.schema)
