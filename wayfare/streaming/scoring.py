"""Scoring a stream of requests: validate, build features, predict, and keep rejects apart."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.functions import requests as R
from wayfare.plans import features, scoring


def read_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """New parquet files under a directory or glob, with a fixed schema."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def score_stream(
    stream: DataFrame,
    artifacts: features.Artifacts,
    predictor: scoring.Predictor,
    model_name: str,
    output: str,
    rejects: str,
    checkpoint: str,
    keep: list[str] | None = None,
):
    """Start a query that scores requests into ``output`` and files bad ones under ``rejects``.

    Stateless, with static broadcast lookups. Each micro-batch lands in its own folder named by
    batch id, overwritten on a retry, so a restarted query never writes a row twice.
    """
    keep = keep or []

    def write(batch: DataFrame, batch_id: int) -> None:
        checked = R.validate(batch).persist()  # both writes read it, the stream is read and checked once
        good = checked.filter(F.col("reject_reason").isNull())
        bad = checked.filter(F.col("reject_reason").isNotNull()).select(*keep, "reject_reason", "pickup_datetime")
        scored = scoring.score(good, artifacts, predictor, model_name, keep)
        scored.write.mode("overwrite").parquet(f"{output}/batch={batch_id}")
        bad.write.mode("overwrite").parquet(f"{rejects}/batch={batch_id}")
        checked.unpersist()

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_to_end(query) -> None:
    """Wait for an available-now query; a failure inside it is raised here."""
    query.awaitTermination()
