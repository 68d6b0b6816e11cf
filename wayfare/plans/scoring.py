"""Scoring of trip requests with the same feature chain as training."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.functions import requests as R
from wayfare.functions import trip
from wayfare.plans import features

# Served predictions are held inside this range of minutes.
SERVED_RANGE = (1, 300)

Predictor = Callable[[DataFrame], DataFrame]


def column_predictor(column: str) -> Predictor:
    """A predictor that reads a feature, such as the route mean or the speed baseline."""
    return lambda df: df.withColumn("prediction", F.col(column))


def model_predictor(model, columns: list[str]) -> Predictor:
    """A fitted pipeline applied to the zero-filled inputs."""

    def predict(df: DataFrame) -> DataFrame:
        filled = {c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)) for c in columns}
        return model.transform(df.withColumns(filled))

    return predict


def score(
    valid: DataFrame,
    artifacts: features.Artifacts,
    predictor: Predictor,
    model_name: str,
    keep: list[str] | None = None,
) -> DataFrame:
    """Prediction, baseline, model name and the request's own pickup text, two decimals each.

    Stateless and narrow, so the same plan serves a batch and a stream.
    """
    scored = predictor(features.apply(R.as_trips(valid), artifacts))
    return scored.select(
        *(keep or []),
        F.round(trip.clip(F.col("prediction"), *SERVED_RANGE), 2).alias("predicted_duration_minutes"),
        F.round("baseline_duration", 2).alias("baseline_duration_minutes"),
        F.lit(model_name).alias("model_used"),
        "pickup_datetime",
    )


def arrivals(scored: DataFrame) -> DataFrame:
    """Arrival time, gain over the baseline, duration band and context of scored requests."""
    pickup = trip.parse_timestamp(F.col("pickup_datetime"))
    predicted, base = F.col("predicted_duration_minutes"), F.col("baseline_duration_minutes")
    arrival = trip.arrival_time(pickup, predicted)
    return scored.withColumns(
        {
            "arrival": F.format_string("%02d:%02d", F.hour(arrival), F.minute(arrival)),
            "delta_minutes": F.round(predicted - base, 2),
            "band": trip.duration_band(predicted),
            "traffic": trip.traffic_context(pickup),
            "day_kind": trip.day_context(pickup),
        }
    )
