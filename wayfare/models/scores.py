"""Validation scores of all models as one nested JSON document, one typed entry per model family.

Every family has the means and spreads over its folds. Ridge adds its best penalty, boosted trees their best parameters.
A family that was not scored is null. Reading names the types, so an empty or partial document has them too.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.operators import metrics
from wayfare.sources import sinks

MEASURES = ["RMSE_mean", "RMSE_std", "MAE_mean", "MAE_std", "R2_mean", "R2_std"]
COMMON = ", ".join(["folds: bigint", *[f"{m}: double" for m in MEASURES]])
EXTRA = {"ridge_regression": "best_alpha: double", "boosted_trees": "best_params: map<string, string>"}
FAMILIES = ["baseline", "linear_regression", "ridge_regression", "boosted_trees", "neural"]
SCHEMA = ", ".join(f"{f} struct<{COMMON}{', ' + EXTRA[f] if f in EXTRA else ''}>" for f in FAMILIES)


def summary(folds: DataFrame) -> DataFrame:
    """Means and spreads per model, from a row of RMSE, MAE and R2 per model and fold."""
    return metrics.fold_summary(folds, ["model"])


def document(summaries: DataFrame, best_alpha: float | None = None, best_params: dict | None = None) -> DataFrame:
    """One row with an entry per family, from a row per model; models of other names are an error of the caller and left out."""
    params = {str(k): str(v) for k, v in (best_params or {}).items()}
    listed = F.create_map(*[F.lit(x) for pair in params.items() for x in pair]).cast("map<string, string>") if params else F.lit(None).cast("map<string, string>")
    extra = {"ridge_regression": [F.lit(best_alpha).cast("double").alias("best_alpha")], "boosted_trees": [listed.alias("best_params")]}

    def entry(family: str):
        scores = F.struct(F.col("folds").cast("long").alias("folds"), *MEASURES)
        found = F.first(F.when(F.col("model") == family, scores), ignorenulls=True)
        fields = [found["folds"].alias("folds"), *[found[m].alias(m) for m in MEASURES], *extra.get(family, [])]
        return F.when(found.isNotNull(), F.struct(*fields)).alias(family)

    return summaries.agg(*[entry(family) for family in FAMILIES])


def write(summaries: DataFrame, path: str, best_alpha: float | None = None, best_params: dict | None = None) -> None:
    sinks.write_json(document(summaries, best_alpha, best_params), path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).json(path)


def listed(found: DataFrame) -> DataFrame:
    """A row per family that was scored; best_params as JSON text with sorted names."""

    def entry(family: str):
        of = F.col(family)
        alpha = of["best_alpha"] if family == "ridge_regression" else F.lit(None).cast("double")
        params = F.lit(None).cast("string")
        if family == "boosted_trees":
            params = F.to_json(F.map_from_entries(F.array_sort(F.map_entries(of["best_params"]))))
        fields = [F.lit(family).alias("model"), of["folds"].alias("folds"), *[of[m].alias(m) for m in MEASURES]]
        return F.struct(*fields, alpha.alias("best_alpha"), params.alias("best_params"))

    return found.select(F.explode(F.array(*[entry(f) for f in FAMILIES])).alias("of")).select("of.*").filter("folds is not null")
