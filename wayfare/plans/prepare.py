"""Preparation: durations, quality rules, duplicates, imputation and typed output."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare import schema as S
from wayfare.functions import trip
from wayfare.operators import quality
from wayfare.operators.impute import Imputer


def prepare(
    raw: DataFrame,
    imputer: Imputer | None = None,
    rules: list[quality.Rule] | None = None,
    dedup: bool = True,
    with_source: bool = False,
) -> DataFrame:
    """Cleaned trips: one lazy plan with a single shuffle, for the duplicates.

    Provenance columns are dropped unless asked for, so that copies found in two files count as
    copies. Durations follow from both times, so they are left out of the shuffle and computed after it.
    """
    columns = [c for c in S.TRIP_COLUMNS if c in raw.columns]
    if with_source:
        columns += [S.SOURCE_YEAR, S.SOURCE_MONTH]
    cleaned = quality.clean(raw.select(*columns).transform(trip.with_duration), rules, dedup=False)
    if dedup:
        cleaned = quality.drop_duplicate_rows(cleaned.select(*columns)).transform(trip.with_duration)
    return imputer.apply(cleaned) if imputer else cleaned


def compact_types(df: DataFrame) -> DataFrame:
    """Narrow types for an export: 16-bit zones, 32-bit floats."""
    floats = [S.PASSENGERS, S.RATE, S.PAYMENT, S.DISTANCE, S.FARE, S.TOTAL, S.TARGET]
    casts = {c: F.col(c).cast("smallint") for c in (S.PU, S.DO)}
    casts.update({c: F.col(c).cast("float") for c in floats if c in df.columns})
    return df.withColumns(casts)
