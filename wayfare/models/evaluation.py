"""Test metrics of fitted or saved models beside the baseline, from one aggregate over one scan."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare import schema as S
from wayfare.models import store
from wayfare.operators import metrics

BASELINE = {"baseline": "baseline_duration"}


def with_predictions(df: DataFrame, models: dict) -> DataFrame:
    """One prediction column per model, named after it. Rows are neither joined nor repeated."""
    for name, model in models.items():
        df = model.transform(df).select(*df.columns, F.col("prediction").alias(name))
    return df


def evaluate_fitted(test: DataFrame, models: dict, baseline: bool = True, label: str = S.TARGET) -> DataFrame:
    columns = {**(BASELINE if baseline else {}), **{name: name for name in models}}
    return metrics.evaluate_models(with_predictions(test, models), label, columns)


def evaluate_saved(test: DataFrame, root: str, names: list[str], label: str = S.TARGET) -> DataFrame:
    """Metrics of the named models saved under a folder; names without a model are skipped."""
    loaded = {name: store.load_model(test.sparkSession, root, name) for name in names}
    return evaluate_fitted(test, {n: m for n, m in loaded.items() if m is not None}, True, label)
