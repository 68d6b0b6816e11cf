"""What saved pipelines say about themselves, as tables: inputs, scaling and the split nodes of trees.

A saved pipeline is a folder of stages, each a line of JSON beside tables. They are read like any other data, so
the ensembles of many fits are summed up by one query, and no model is loaded.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.ml.functions import vector_to_array

STAGE = r"^(.*)/stages/0*(\d+)_"


def _place() -> list[Column]:
    """The pipeline's folder and the number of the stage that a file belongs to."""
    path = F.input_file_name()
    return [F.regexp_extract(path, STAGE, 1).alias("saved"), F.regexp_extract(path, STAGE, 2).cast("int").alias("stage")]


def inputs(spark: SparkSession, saved: str) -> DataFrame:
    """Ordered inputs of every assembler of the saved pipelines (a folder or a pattern of folders): saved, stage, position, feature."""
    described = spark.read.json(f"{saved}/stages/*_VectorAssembler_*/metadata", schema="paramMap struct<inputCols: array<string>>")
    return described.select(*_place(), F.posexplode("paramMap.inputCols").alias("position", "feature"))


def scaling(spark: SparkSession, saved: str) -> DataFrame:
    """Mean and deviation that every scaler of the saved pipelines subtracts and divides by: saved, stage, position, mean, std."""
    scalers = spark.read.parquet(f"{saved}/stages/*_StandardScaler_*/data")
    both = F.arrays_zip(vector_to_array("mean").alias("mean"), vector_to_array("std").alias("std"))
    listed = scalers.select(*_place(), F.posexplode(both).alias("position", "of"))
    return listed.select("saved", "stage", "position", "of.mean", "of.std")


def nodes(spark: SparkSession, saved: str) -> DataFrame:
    """Split nodes of every tree of the saved pipelines: saved, stage, node, feature, threshold, rows, gain.

    Gain is the reduction of squared error over the node's rows. A tree's inputs are those of the assembler one stage before it.
    """
    trees = spark.read.parquet(f"{saved}/stages/*_DecisionTreeRegressor_*/data").select(*_place(), "*").filter("leftChild >= 0")
    rows = F.col("impurityStats")[0]
    split = trees.select(
        "saved",
        "stage",
        (F.col("stage") - 1).alias("before"),
        F.col("id").alias("node"),
        F.col("split.featureIndex").alias("position"),
        F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        rows.alias("rows"),
        (F.col("gain") * rows).alias("gain"),
    )
    named = inputs(spark, saved).withColumnRenamed("stage", "before")
    return split.join(named, ["saved", "before", "position"]).select("saved", "stage", "node", "feature", "threshold", "rows", "gain")


def importance(spark: SparkSession, saved: str) -> DataFrame:
    """Total gain, number of splits and share of all gain of every input that the saved trees split on."""
    totals = nodes(spark, saved).groupBy("feature").agg(F.sum("gain").alias("gain"), F.count(F.lit(1)).alias("splits"))
    # a row per input, so the list stays short
    listed = totals.agg(F.collect_list(F.struct("*")).alias("of"), F.sum("gain").alias("whole"))
    rows = listed.select(F.explode("of").alias("of"), "whole")
    return rows.select("of.*", (F.col("of.gain") / F.col("whole")).alias("importance"))


def top_importance(spark: SparkSession, saved: str, k: int = 25) -> DataFrame:
    """The k inputs of the largest gain, ties by name."""
    return importance(spark, saved).orderBy(F.col("gain").desc(), "feature").limit(k)
