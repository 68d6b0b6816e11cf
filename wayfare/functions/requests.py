"""Scoring requests: coercion of untrusted fields, defaults, and reasons for rejection."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare import schema as S
from wayfare.functions import trip

# Fixed defaults of optional request fields.
DEFAULTS = {"passenger_count": 1, "rate_code_id": 1, "payment_type": 1, "fare_amount": 10.0}

REQUEST_TO_TRIP = {
    "pickup_location_id": S.PU,
    "dropoff_location_id": S.DO,
    "trip_distance": S.DISTANCE,
    "passenger_count": S.PASSENGERS,
    "rate_code_id": S.RATE,
    "payment_type": S.PAYMENT,
    "fare_amount": S.FARE,
}


def coerce(requests: DataFrame, estimate_fare: bool = False) -> DataFrame:
    """Typed request fields: unreadable distances become 0, unreadable times null, gaps defaults.

    With ``estimate_fare`` a missing fare is 3.5 per mile, as a person entering a trip by hand is
    offered; otherwise it is the fixed default.
    """
    typed = requests.withColumns(
        {
            "trip_distance": trip.to_number(F.col("trip_distance").cast("string")),
            "pickup_ts": trip.parse_timestamp(F.col("pickup_datetime").cast("string")),
        }
    )
    fills = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in DEFAULTS.items()}
    if estimate_fare:
        fills["fare_amount"] = trip.estimated_fare(F.col("fare_amount"), F.col("trip_distance"))
    return typed.withColumns(fills)


def reject_reason(zone_low: int = S.MIN_ZONE, zone_high: int = S.MAX_ZONE) -> Column:
    """The first range check a coerced request fails; null for a valid one."""
    checks = [
        ("pickup_location_id", F.col("pickup_location_id").between(zone_low, zone_high)),
        ("dropoff_location_id", F.col("dropoff_location_id").between(zone_low, zone_high)),
        ("trip_distance", (F.col("trip_distance") > 0) & ~F.isnan("trip_distance")),
        ("pickup_datetime", F.col("pickup_ts").isNotNull()),
        ("passenger_count", F.col("passenger_count").between(S.MIN_PASSENGERS, S.MAX_PASSENGERS)),
        ("rate_code_id", F.col("rate_code_id").between(1, 6)),
        ("payment_type", F.col("payment_type").between(1, 6)),
        ("fare_amount", (F.col("fare_amount") >= 0) & ~F.isnan("fare_amount")),
    ]
    result = F.lit(None).cast("string")
    for name, valid in reversed(checks):
        result = F.when(F.coalesce(valid, F.lit(False)), result).otherwise(name)
    return result


def validate(requests: DataFrame, estimate_fare: bool = False) -> DataFrame:
    """Coerced requests with a ``reject_reason`` column."""
    return coerce(requests, estimate_fare).withColumn("reject_reason", reject_reason())


def as_trips(valid: DataFrame) -> DataFrame:
    """Valid requests under the trip column names, ready for the feature chain."""
    renamed = valid.withColumnsRenamed({a: b for a, b in REQUEST_TO_TRIP.items() if a != b})
    return renamed.withColumns(
        {S.PICKUP: F.col("pickup_ts"), **{c: F.col(c).cast("double") for c in (S.PASSENGERS, S.RATE, S.PAYMENT)}}
    )
