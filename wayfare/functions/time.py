"""Calendar features of a pickup timestamp, as column expressions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare import schema as S

# Fixed periods of the cyclic encodings.
CYCLES = {"hour": ("hour", 24), "dow": ("day_of_week", 7), "month": ("month", 12)}

# Fixed labels.
DAY_LABELS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
MONTH_LABELS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


EPOCH = "1970-01-01 00:00:00"


def moment(text: str) -> Column:
    """A zone-free timestamp literal."""
    return F.lit(text).cast("timestamp_ntz")


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds, as a bigint. Zone-free times subtract without any time zone."""
    return (end - start).cast("interval second").cast("bigint")


def exact_seconds_between(start: Column, end: Column) -> Column:
    """Seconds with their microseconds, as a decimal."""
    return (end - start).cast("interval second").cast("decimal(20,6)")


def epoch_seconds(ts: Column) -> Column:
    return seconds_between(moment(EPOCH), ts)


def epoch_micros(ts: Column) -> Column:
    return (exact_seconds_between(moment(EPOCH), ts) * 1_000_000).cast("bigint")


def is_rush_hour(hour: Column) -> Column:
    return (hour.between(7, 9) | hour.between(16, 19)).cast("int")


def is_night(hour: Column) -> Column:
    return ((hour >= 22) | (hour <= 5)).cast("int")


def is_weekend(ts: Column) -> Column:
    return (F.weekday(ts) >= 5).cast("int")


def calendar_columns(ts: Column) -> dict[str, Column]:
    """Calendar parts and flags; days count from Monday = 0, weeks are ISO weeks."""
    return {
        "hour": F.hour(ts),
        "day_of_week": F.weekday(ts),
        "day_of_month": F.dayofmonth(ts),
        "month": F.month(ts),
        "year": F.year(ts),
        "quarter": F.quarter(ts),
        "week_of_year": F.weekofyear(ts),
        "is_weekend": is_weekend(ts),
        "is_rush_hour": is_rush_hour(F.hour(ts)),
        "is_night": is_night(F.hour(ts)),
    }


def cyclic(value: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a value on a circle of the given period."""
    angle = F.lit(2.0) * F.pi() * value / F.lit(period)
    return F.sin(angle), F.cos(angle)


def with_time_features(df: DataFrame, ts: str = S.PICKUP) -> DataFrame:
    return df.withColumns(calendar_columns(F.col(ts)))


def with_cyclic_features(df: DataFrame) -> DataFrame:
    """Needs hour, day_of_week and month."""
    columns = {}
    for name, (source, period) in CYCLES.items():
        columns[f"{name}_sin"], columns[f"{name}_cos"] = cyclic(F.col(source), period)
    return df.withColumns(columns)


def day_label(day_of_week: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, DAY_LABELS)), day_of_week + 1)


def month_label(month: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, MONTH_LABELS)), month)
