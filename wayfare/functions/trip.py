"""Scalar trip expressions: duration, distance, location, interaction, error and label columns."""

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare import schema as S
from wayfare.functions import time as calendar

# Rate-code labels and borough codes.
RATE_LABELS = {1: "Standard", 2: "JFK", 3: "Newark", 4: "Nassau/Westchester", 5: "Negotiated", 6: "Group"}
BOROUGH_CODES = {"Manhattan": 1, "Bronx": 2, "Brooklyn": 3, "Queens": 4, "Staten Island": 5, "EWR": 6}

# Right-closed distance bands: (low, high, label).
DISTANCE_BANDS = [
    (0, 1, "<1mi"),
    (1, 2, "1-2mi"),
    (2, 5, "2-5mi"),
    (5, 10, "5-10mi"),
    (10, 20, "10-20mi"),
    (20, 100, ">20mi"),
]

# Display bands of a predicted duration in minutes: (low, high, label).
DURATION_BANDS = [(0, 20, "short"), (20, 45, "medium"), (45, 120, "long")]


def parse_timestamp(value: Column) -> Column:
    """Zone-free timestamp of untrusted text; null where it cannot be read."""
    return value.try_cast("timestamp_ntz")


def duration_minutes(start: Column, end: Column) -> Column:
    """Signed minutes from start to end."""
    return calendar.exact_seconds_between(start, end).cast("double") / F.lit(60.0)


def duration_seconds(start: Column, end: Column) -> Column:
    """Whole seconds from start to end. Integers sum to the same total in any order."""
    return calendar.seconds_between(start, end)


def with_duration(df: DataFrame) -> DataFrame:
    start, end = F.col(S.PICKUP), F.col(S.DROPOFF)
    return df.withColumns({S.TARGET: duration_minutes(start, end), S.SECONDS: duration_seconds(start, end)})


def log_distance(distance: Column) -> Column:
    return F.log1p(distance)


def baseline_duration(distance: Column, speed_mph) -> Column:
    """Minutes to cover the distance at one constant speed."""
    return distance / F.lit(speed_mph) * F.lit(60.0)


def implied_speed(distance: Column, minutes: Column) -> Column:
    """Miles per hour; null for a zero duration."""
    return F.try_divide(distance, minutes) * F.lit(60.0)


def same_zone(pickup: Column, dropoff: Column) -> Column:
    return (pickup == dropoff).cast("int")


def borough_code(borough: Column, codes: dict[str, int] | None = None) -> Column:
    """Fixed code of a borough name; 0 for a missing or unlisted one."""
    result = F.lit(0)
    for name, code in (codes or BOROUGH_CODES).items():
        result = F.when(borough == name, code).otherwise(result)
    return result


def rate_label(code: Column) -> Column:
    """Name of a rate code; the code itself as text where it has no name."""
    text = code.cast("int").cast("string")
    result = text
    for key, label in RATE_LABELS.items():
        result = F.when(code == key, label).otherwise(result)
    return result


def with_distance_features(df: DataFrame, speed_mph: float = S.DEFAULT_SPEED_MPH) -> DataFrame:
    distance = F.col(S.DISTANCE)
    return df.withColumns(
        {"log_distance": log_distance(distance), "baseline_duration": baseline_duration(distance, speed_mph)}
    )


def with_interactions(df: DataFrame) -> DataFrame:
    """Needs the time features."""
    distance = F.col(S.DISTANCE)
    return df.withColumns(
        {
            "distance_x_rush": distance * F.col("is_rush_hour"),
            "distance_x_weekend": distance * F.col("is_weekend"),
            "distance_x_hour": distance * F.col("hour"),
        }
    )


def clip(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """Value held inside [low, high]; a missing value stays missing."""
    result = value
    if low is not None:
        result = F.when(result < low, F.lit(float(low))).otherwise(result)
    if high is not None:
        result = F.when(result > high, F.lit(float(high))).otherwise(result)
    return result


def with_errors(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Signed error (predicted - actual), absolute error and percentage error."""
    error = F.col(predicted) - F.col(actual)
    return df.withColumns(
        {
            "error_minutes": error,
            "abs_error": F.abs(error),
            "pct_error": F.try_divide(F.abs(error), F.col(actual)) * 100,
        }
    )


def distance_band(distance: Column) -> Column:
    """Label of the right-closed distance band; null at or below 0 and above 100 miles."""
    result = F.lit(None).cast("string")
    for low, high, label in DISTANCE_BANDS:
        result = F.when((distance > low) & (distance <= high), label).otherwise(result)
    return result


def distance_band_order(distance: Column) -> Column:
    result = F.lit(None).cast("int")
    for order, (low, high, _) in enumerate(DISTANCE_BANDS):
        result = F.when((distance > low) & (distance <= high), order).otherwise(result)
    return result


def duration_band(minutes: Column) -> Column:
    """Display band of a duration, left-closed; null outside 0..120 minutes."""
    result = F.lit(None).cast("string")
    for low, high, label in DURATION_BANDS:
        result = F.when((minutes >= low) & (minutes < high), label).otherwise(result)
    last = DURATION_BANDS[-1]
    return F.when(minutes == last[1], last[2]).otherwise(result)


def traffic_context(ts: Column) -> Column:
    hour = F.hour(ts)
    return F.when(hour.between(7, 9) | hour.between(16, 19), "rush").otherwise("off-peak")


def day_context(ts: Column) -> Column:
    return F.when(F.weekday(ts) >= 5, "weekend").otherwise("weekday")


def arrival_time(pickup: Column, minutes: Column) -> Column:
    """Pickup plus predicted minutes, to the second."""
    return F.timestamp_add("SECOND", F.round(minutes * 60).cast("int"), pickup)


def to_number(value: Column) -> Column:
    """Number of untrusted text; 0 where it cannot be read."""
    number = value.try_cast("double")
    return F.coalesce(F.nanvl(number, F.lit(0.0)), F.lit(0.0))


def estimated_fare(fare: Column, distance: Column) -> Column:
    """The given fare, or 3.5 per mile in whole cents where none is given."""
    return F.coalesce(fare, F.round(distance.cast("decimal(18,6)") * F.lit(Decimal("3.5")), 2).cast("double"))
