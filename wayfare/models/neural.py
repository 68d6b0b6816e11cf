"""A neural duration model: classify into duration bands, then average the band means.

The library has a multilayer classifier but no multilayer regressor. The network therefore predicts
the probability of each duration band, and the prediction is the probability-weighted mean duration.
"""

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.feature import QuantileDiscretizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare import schema as S
from wayfare import session
from wayfare.models.paths import exists
from wayfare.models.pipelines import SEED, scaled_features

# Fixed sizes of the hidden layers.
HIDDEN_LAYERS = [256, 128, 64]
PART = 20  # iterations saved together


@dataclass(frozen=True)
class BandModel:
    network: PipelineModel
    band_means: list[float]

    def transform(self, df: DataFrame) -> DataFrame:
        scored = self.network.transform(df)
        means = F.array(*[F.lit(m) for m in self.band_means])
        terms = F.zip_with(vector_to_array("probability"), means, lambda p, m: p * m)
        expected = F.aggregate(terms, F.lit(0.0), lambda total, term: total + term)
        return scored.withColumn("prediction", expected)


def _steps(scaled: DataFrame, layers: list[int], max_iter: int, part: int, seed: int, root: str):
    """The network after ``max_iter`` iterations in parts. Each part starts from the weights the last one saved below ``root``."""
    spark, network = scaled.sparkSession, None
    for number in range(-(-max_iter // part)):
        path = f"{root}/part-{number:04d}"
        if not exists(spark, f"{path}/metadata/_SUCCESS") or not exists(spark, f"{path}/data/_SUCCESS"):
            todo = min(part, max_iter - number * part)
            learner = MultilayerPerceptronClassifier(
                featuresCol="scaled", labelCol="band", predictionCol="band_prediction", layers=layers, maxIter=todo, seed=seed
            )
            if network is not None:
                learner = learner.setInitialWeights(network.weights)
            learner.fit(scaled).write().overwrite().save(path)
        network = MultilayerPerceptronClassificationModel.load(path)
    return network


def fit_bands(
    train: DataFrame,
    columns: list[str],
    bands: int = 10,
    hidden: list[int] = HIDDEN_LAYERS,
    max_iter: int = 200,
    label: str = S.TARGET,
    seed: int = SEED,
    root: str | None = None,
    part: int = PART,
) -> BandModel:
    """Fit in parts of ``part`` iterations, saved below ``root``; a fit that was cut off goes on after its last whole part.

    A part starts the solver afresh from the weights before it, so ``part`` belongs to the result: runs with the same parts
    are equal whether they were interrupted or not. The scaled inputs are written once and read by every part.
    """
    spark = train.sparkSession
    root = root or session.scratch_path(spark, "network")
    binner = QuantileDiscretizer(numBuckets=bands, inputCol=label, outputCol="band", relativeError=0.001).fit(train)
    banded = binner.transform(train)
    means = banded.groupBy("band").agg(F.avg(label).alias("m")).orderBy("band").collect()  # one row per band
    scaler = scaled_features(columns).fit(banded)
    path = session.scratch_path(spark, "scaled")
    scaler.transform(banded).select("scaled", "band").write.parquet(path)
    network = _steps(spark.read.parquet(path), [len(columns), *hidden, len(means)], max_iter, part, seed, root)
    return BandModel(PipelineModel([*scaler.stages, network]), [r.m for r in means])
