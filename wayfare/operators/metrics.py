"""Regression metrics and comparisons, each from one aggregate over the predictions."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions import trip
from wayfare.operators.profiling import extremes

# Fixed success targets.
MAX_RMSE, MAX_MAE, MIN_R2 = 5.0, 3.0, 0.80


def r_squared(sse: Column, sst: Column) -> Column:
    """1 - SSE/SST; for a constant target 1 when it is met exactly, else 0."""
    return F.when(sst > 0, 1 - sse / sst).otherwise(F.when(sse == 0, 1.0).otherwise(0.0))


def regression_metrics(actual: Column, predicted: Column, round_to: int | None = 4) -> dict[str, Column]:
    """RMSE, MAE, R2 and MAPE (percent, over nonzero actuals) as aggregate columns."""
    pair = actual.isNotNull() & predicted.isNotNull()
    y, error = F.when(pair, actual), actual - predicted
    n, sse = F.count(error), F.sum(error * error)
    # the shifted sums of var_pop avoid the cancellation of sum(y^2) - sum(y)^2 / n
    metrics = {
        "RMSE": F.sqrt(sse / n),
        "MAE": F.avg(F.abs(error)),
        "R2": r_squared(sse, F.var_pop(y) * n),
        "MAPE": F.avg(F.when(y != 0, F.abs(error / y))) * 100,
    }
    return {k: F.round(v, round_to) if round_to is not None else v for k, v in metrics.items()}


def evaluate_models(
    df: DataFrame,
    actual: str,
    models: dict[str, str],
    by: list[str] | None = None,
    round_to: int | None = 4,
) -> DataFrame:
    """One row of metrics per model, from columns of predictions clipped at zero.

    All models are measured in the same aggregate over one scan; rows are not multiplied.
    """
    by = by or []
    measured = {
        name: regression_metrics(F.col(actual), trip.clip(F.col(column), low=0), round_to)
        for name, column in models.items()
    }
    flat = [m.alias(f"_{i}_{k}") for i, metrics in enumerate(measured.values()) for k, m in metrics.items()]
    wide = df.groupBy(*by).agg(F.count(actual).alias("rows"), *flat)
    entries = [
        F.struct(F.lit(name).alias("model"), "rows", *[F.col(f"_{i}_{k}").alias(k) for k in metrics])
        for i, (name, metrics) in enumerate(measured.items())
    ]
    return wide.select(*by, F.inline(F.array(*entries)))


def leaderboard(metrics: DataFrame, baseline: str = "baseline") -> DataFrame:
    """Models by RMSE, with gains over the baseline and the best trained model flagged."""
    is_base = F.col("model") == baseline
    # one row per model, so the list stays as short as the board
    gathered = metrics.agg(
        F.collect_list(F.struct(*metrics.columns)).alias("rows"),
        *[F.max(F.when(is_base, F.col(m))).alias(f"base_{m}") for m in ("RMSE", "MAE", "R2")],
        F.min(F.when(~is_base, F.struct("RMSE", "model"))).getField("model").alias("best"),
    )
    board = gathered.select(F.explode("rows").alias("m"), "base_RMSE", "base_MAE", "base_R2", "best").select(
        "m.*", "base_RMSE", "base_MAE", "base_R2", "best"
    )
    return board.select(
        *metrics.columns,
        F.round((F.col("base_RMSE") - F.col("RMSE")) / F.col("base_RMSE") * 100, 4).alias("rmse_gain_pct"),
        F.round((F.col("base_MAE") - F.col("MAE")) / F.col("base_MAE") * 100, 4).alias("mae_gain_pct"),
        F.round(F.col("R2") - F.col("base_R2"), 4).alias("r2_gain"),
        F.coalesce(F.col("model") == F.col("best"), F.lit(False)).alias("is_best"),
    ).orderBy("RMSE", "model")


def success_criteria(board: DataFrame, baseline: str = "baseline") -> DataFrame:
    """The four targets, what the best model achieved, and PASS or FAIL."""
    best = board.agg(
        *[F.max(F.when(F.col("is_best"), F.col(m))).alias(m) for m in ("RMSE", "MAE", "R2")],
        F.max(F.when(F.col("model") == baseline, F.col("RMSE"))).alias("base"),
    )
    checks = [
        ("RMSE", F.lit(MAX_RMSE), F.col("RMSE"), F.col("RMSE") < MAX_RMSE),
        ("MAE", F.lit(MAX_MAE), F.col("MAE"), F.col("MAE") < MAX_MAE),
        ("R2", F.lit(MIN_R2), F.col("R2"), F.col("R2") > MIN_R2),
        ("beats_baseline", F.col("base"), F.col("RMSE"), F.col("RMSE") < F.col("base")),
    ]
    entries = [
        F.struct(
            F.lit(name).alias("criterion"),
            target.alias("target"),
            achieved.alias("achieved"),
            F.when(passed, "PASS").otherwise("FAIL").alias("status"),
        )
        for name, target, achieved, passed in checks
    ]
    return best.select(F.inline(F.array(*entries)))


def residual_summary(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Bias, spread and the share of predictions within 5 and 3 minutes, over all rows."""
    error = F.col(predicted) - F.col(actual)
    return df.agg(
        F.count(error).alias("rows"),
        F.round(F.avg(error), 6).alias("mean_error"),
        F.round(F.stddev_pop(error), 6).alias("std_error"),
        F.round(F.avg((F.abs(error) <= 5).cast("int")) * 100, 4).alias("within_5_pct"),
        F.round(F.avg((F.abs(error) <= 3).cast("int")) * 100, 4).alias("within_3_pct"),
    )


def mean_error_by(df: DataFrame, *keys: str) -> DataFrame:
    """Mean absolute error per group; groups without rows are absent."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.round(F.avg("abs_error"), 6).alias("mae"))


def error_extremes(df: DataFrame, key: str = "hour") -> DataFrame:
    """Worst and best group by mean absolute error."""
    return extremes(mean_error_by(df, key), key, "mae")


def fold_summary(folds: DataFrame, by: list[str], metrics: tuple[str, ...] = ("RMSE", "MAE", "R2")) -> DataFrame:
    """Mean and population standard deviation of each metric over the folds."""
    pairs = [(F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_std")) for m in metrics]
    flat = reduce(lambda a, b: a + list(b), pairs, [])
    summary = folds.groupBy(*by).agg(F.count(F.lit(1)).alias("folds"), *flat)
    return summary.select(*by, "folds", *[F.round(f"{m}_{s}", 4).alias(f"{m}_{s}") for m in metrics for s in ("mean", "std")])
