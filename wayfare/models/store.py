"""Model persistence: one saved model per name, with its ordered input list.

A neural band model is its network beside a small table of band means.
"""

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from wayfare import session
from wayfare.models.neural import BandModel
from wayfare.models.paths import exists


def save_model(model: PipelineModel | BandModel, root: str, name: str) -> str:
    path = f"{root}/{name}"
    if isinstance(model, BandModel):
        model.network.write().overwrite().save(f"{path}/network")
        spark = SparkSession.active()
        means = session.literal_rows(spark, list(enumerate(map(float, model.band_means))), "band int, mean double")
        means.write.mode("overwrite").parquet(f"{path}/band_means")
    else:
        model.write().overwrite().save(path)
    return path


def load_model(spark: SparkSession, root: str, name: str) -> PipelineModel | BandModel | None:
    """The saved model, or None if there is none of that name."""
    path = f"{root}/{name}"
    if exists(spark, f"{path}/network/metadata"):
        means = spark.read.parquet(f"{path}/band_means").orderBy("band").collect()  # a row per band
        return BandModel(PipelineModel.load(f"{path}/network"), [r["mean"] for r in means])
    return PipelineModel.load(path) if exists(spark, f"{path}/metadata") else None


def input_columns(model: PipelineModel | BandModel) -> list[str]:
    """Ordered inputs of a saved model; the list travels inside it."""
    pipeline = model.network if isinstance(model, BandModel) else model
    return list(pipeline.stages[0].getInputCols())
