"""A training corpus from raw documents: language, quality, near copies, mixture, packing.

Each stage takes (spark, docs, sf_dir), works on everything its predecessor kept, and is written as Parquet before the
next one reads it. All but the last return the columns of ``documents``. Texts reach Python workers in batches of 2,000 rows
unless the session sets another number.
"""

from pyspark.sql import DataFrame, SparkSession

from wayfare.llm import jaccard, language, mixing, packing, quality_rules
from wayfare.llm.common import small_batches, stage, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return language.identified_documents(docs)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return quality_rules.kept_documents(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return jaccard.distinct_documents(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return packing.pack(docs)


STAGES = [
    ("language", known_language),
    ("quality", good_quality),
    ("near copies", one_of_each),
    ("mixture", mixture),
    ("packing", packed),
]
#: A string kernel and an isolation forest are not SQL: tests compare the stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
