"""Regression pipelines: assemblers, scaling, linear, tree and neural models with their presets."""

from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare import schema as S

SEED = 42

# Fixed alpha grids of the two pipeline variants.
FULL_ALPHAS = [0.01, 0.1, 1.0, 10.0, 100.0, 1000.0]
SHORT_ALPHAS = [0.1, 1.0, 10.0, 100.0, 1000.0]

# Fixed random-search space; ``boosting.settings_of`` turns a point into settings.
BOOSTING_SPACE = {
    "num_leaves": [31, 63, 127, 255],
    "learning_rate": [0.01, 0.05, 0.1, 0.2],
    "n_estimators": [200, 500, 1000],
    "max_depth": [-1, 6, 10, 15],
    "min_child_samples": [20, 50, 100],
    "subsample": [0.7, 0.8, 0.9, 1.0],
    "colsample_bytree": [0.7, 0.8, 0.9, 1.0],
    "reg_alpha": [0.0, 0.1, 0.5],
    "reg_lambda": [0.0, 0.1, 1.0],
}
SEARCH_DRAWS = 30
PATIENCE = 50  # rounds without a lower held-out error before growing ends


def assembler(columns: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="error")


def scaled_features(columns: list[str]) -> Pipeline:
    """Zero mean, unit sample deviation."""
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    return Pipeline(stages=[assembler(columns), scaler])


def linear_regression(columns: list[str], label: str = S.TARGET) -> Pipeline:
    """Ordinary least squares on scaled inputs.

    One pass gathers the normal equations; collinear inputs, such as a distance and its multiple,
    make the solver fall back to an iterative fit of the same sums.
    """
    regression = LinearRegression(featuresCol="scaled", labelCol=label, regParam=0.0, solver="auto", standardization=False)
    return Pipeline(stages=[*scaled_features(columns).getStages(), regression])


def ridge_regression(columns: list[str], alpha: float, rows: int, label_std: float, label: str = S.TARGET) -> Pipeline:
    """Ridge with penalty ``alpha`` on inputs scaled to unit population deviation.

    The library minimises squared error over 2n plus regParam / 2 per weight, on a label divided by
    its deviation, so the matching regParam is alpha * std(label) / n. It scales inputs by itself.
    """
    regression = LinearRegression(
        labelCol=label,
        elasticNetParam=0.0,
        regParam=alpha * label_std / rows,
        solver="normal",
        standardization=True,
    )
    return Pipeline(stages=[assembler(columns), regression])


def boosted_trees(columns: list[str], label: str = S.TARGET, validation: str | None = None, seed: int = SEED, **params) -> Pipeline:
    """Gradient-boosted trees. With a validation column, rounds end once they stop paying off.

    Node statistics are merged map-side per bin, so what moves does not grow with the rows;
    lineage is cut every ten rounds through the checkpoint folder.
    """
    # the default tolerance would stop on the first noisy round
    stopping = dict(validationIndicatorCol=validation, validationTol=1e-6) if validation else {}
    trees = GBTRegressor(labelCol=label, seed=seed, checkpointInterval=10, cacheNodeIds=True, **stopping, **params)
    return Pipeline(stages=[assembler(columns), trees])


def with_validation_block(train: DataFrame, column: str = "is_validation", block: str = "block") -> DataFrame:
    """Mark the latest time block for early stopping, so the test period stays unseen."""
    latest = train.agg(F.max(block)).first()[0]
    return train.withColumn(column, F.col(block) == F.lit(latest))
