"""Profiling aggregates over cleaned trips.

Order statistics start from value counts: trips are first counted per distinct second, merging
map-side, and only those counts (10,741 possible values after cleaning) reach the quantile. A
group holding most of the rows is no larger than any other by then.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare import schema as S
from wayfare.functions import trip
from wayfare.operators.selection import exact_quantiles, quantiles_of

DESCRIBE_PERCENTILES = [0.25, 0.5, 0.75, 0.90, 0.95, 0.99]
CORRELATED = [S.TARGET, S.DISTANCE, S.FARE, S.TOTAL, S.PASSENGERS]


def second_counts(df: DataFrame, *keys: str) -> DataFrame:
    """Trips per distinct whole-second duration, within optional keys."""
    return df.groupBy(*keys, S.SECONDS).agg(F.count(F.lit(1)).alias("n"))


def mean_minutes(total: Column, count: Column) -> Column:
    return total / (count * F.lit(60.0))


def sample_std_minutes(n: Column, total: Column, squares: Column) -> Column:
    """Sample standard deviation from exact integer sums, in minutes; null for one row."""
    wide = "decimal(38,0)"
    spread = (n.cast(wide) * squares.cast(wide) - total.cast(wide) * total.cast(wide)).cast("double")
    return F.when(n > 1, F.sqrt(spread / (n.cast("double") * (n - 1).cast("double"))) / 60.0)


def _weighted_sums() -> list[Column]:
    s, n = F.col(S.SECONDS), F.col("n")
    return [
        F.sum(n).alias("trips"),
        F.sum(s * n).alias("total_s"),
        F.sum((s * s).cast("decimal(20,0)") * n).alias("squares"),
    ]


def duration_summary(df: DataFrame) -> DataFrame:
    """Min, max, mean and median minutes of any trip table, raw ones included.

    Raw durations have no bound, so the median comes from rank selection, not from value counts.
    """
    median = exact_quantiles(df, F.col(S.SECONDS), [0.5])[0]
    seconds = F.col(S.SECONDS)
    return df.agg(
        F.count(seconds).alias("trips"),
        F.round(F.min(seconds) / 60.0, 6).alias("min_minutes"),
        F.round(F.max(seconds) / 60.0, 6).alias("max_minutes"),
        F.round(mean_minutes(F.sum(seconds), F.count(seconds)), 6).alias("mean_minutes"),
        F.round(F.lit(median) / 60.0, 6).alias("median_minutes"),
    )


def describe_duration(df: DataFrame, percentiles: list[float] = DESCRIBE_PERCENTILES) -> DataFrame:
    """Count, mean, sample std, min, quantiles and max of cleaned durations, in minutes."""
    s = F.col(S.SECONDS)
    base = second_counts(df).agg(
        *_weighted_sums(),
        F.min(s).alias("lo"),
        F.max(s).alias("hi"),
        F.percentile(s, percentiles, F.col("n")).alias("q"),
    )
    return base.select(
        F.col("trips").alias("count"),
        F.round(mean_minutes(F.col("total_s"), F.col("trips")), 6).alias("mean"),
        F.round(sample_std_minutes(F.col("trips"), F.col("total_s"), F.col("squares")), 6).alias("std"),
        F.round(F.col("lo") / 60.0, 6).alias("min"),
        *[F.round(F.col("q")[i] / 60.0, 6).alias(f"p{round(p * 100)}") for i, p in enumerate(percentiles)],
        F.round(F.col("hi") / 60.0, 6).alias("max"),
    )


def mean_duration_by(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("trips"),
        F.round(mean_minutes(F.sum(S.SECONDS), F.count(S.SECONDS)), 6).alias("mean_minutes"),
    )


def hour_by_day(df: DataFrame, value: str = "mean") -> DataFrame:
    """Hour x weekday table of mean minutes, or of trip counts. Explicit pivot values save a pass."""
    cell = F.count(F.lit(1)) if value == "count" else F.round(mean_minutes(F.sum(S.SECONDS), F.count(S.SECONDS)), 6)
    wide = df.groupBy("hour").pivot("day_of_week", list(range(7))).agg(cell)
    return wide.toDF("hour", "mon", "tue", "wed", "thu", "fri", "sat", "sun")


def extremes(grouped: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with the largest and smallest value; the smallest key on ties."""
    return grouped.agg(
        F.max_by(F.col(key), F.struct(F.col(value), -F.col(key))).alias(f"max_{key}"),
        F.max(value).alias(f"max_{value}"),
        F.min_by(F.col(key), F.struct(F.col(value), F.col(key))).alias(f"min_{key}"),
        F.min(value).alias(f"min_{value}"),
    )


def correlation_matrix(df: DataFrame, columns: list[str] = CORRELATED) -> DataFrame:
    """Lower triangle of pairwise-complete Pearson correlations, one aggregate, long output."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[:i]]
    wide = df.agg(*[F.corr(a, b).alias(f"_c{i}") for i, (a, b) in enumerate(pairs)])
    entries = [
        F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.col(f"_c{i}").alias("correlation"))
        for i, (a, b) in enumerate(pairs)
    ]
    return wide.select(F.inline(F.array(*entries)))


def value_counts(df: DataFrame, key: str, name: str = "trips") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def top_zones(df: DataFrame, zone_column: str, zones: DataFrame, k: int = 20) -> DataFrame:
    """The k busiest zones with their labels. Ties go to the smaller id.

    The top k are taken before the zone table is joined, so the join sees k rows.
    """
    busiest = (
        value_counts(df, zone_column)
        .withColumnRenamed(zone_column, "LocationID")
        .orderBy(F.col("trips").desc(), F.col("LocationID"))
        .limit(k)
    )
    named = busiest.join(zones.select("LocationID", "Zone", "Borough"), "LocationID", "left")
    label = F.coalesce(F.col("Zone"), F.col("LocationID").cast("string"))
    ranked = named.orderBy(F.col("trips").desc(), F.col("LocationID"))  # the join kept no order
    return ranked.select("LocationID", label.alias("zone_label"), "Borough", "trips")


def histogram(df: DataFrame, column: Column, bins: int = 100) -> DataFrame:
    """Equal-width bins over min..max, the last one closed on the right; empty bins included. NaN counts as missing."""
    values = df.select(column.cast("double").alias("x")).filter(F.col("x").isNotNull() & ~F.isnan("x"))
    lo, hi = values.agg(F.min("x"), F.max("x")).first()
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    if lo is None:
        return every.select("bin", *[F.lit(None).cast("double").alias(c) for c in ("bin_low", "bin_high")], F.lit(0).cast("bigint").alias("n"))
    lo, hi = float(lo), float(hi)
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    slot = F.least(F.floor((F.col("x") - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = values.groupBy(slot.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return every.join(counts, "bin", "left").select(
        "bin",
        F.round(F.lit(lo) + F.col("bin") * F.lit(width), 9).alias("bin_low"),
        F.round(F.lit(lo) + (F.col("bin") + 1) * F.lit(width), 9).alias("bin_high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def box_stats(df: DataFrame, *keys: str, factor: float = 1.5) -> DataFrame:
    """Quartiles and whiskers of cleaned durations, in minutes, overall or per key.

    Whiskers are the outermost values within ``factor`` x IQR of the quartiles. Both steps run on
    the counts per second, not on trips; with keys, the second one reuses the shuffle of the first.
    """
    s, n = F.col(S.SECONDS), F.col("n")
    counts = second_counts(df, *keys)
    quartiles = counts.groupBy(*keys).agg(F.percentile(s, [0.25, 0.5, 0.75], n).alias("q"), F.sum(n).alias("trips"))
    if keys:
        counts = counts.join(quartiles, list(keys))
    else:
        whole = quartiles.first()
        q = F.array(*[F.lit(v).cast("double") for v in whole.q or [None] * 3])
        counts = counts.withColumns({"q": q, "trips": F.lit(whole.trips).cast("bigint")})
    reach = (F.col("q")[2] - F.col("q")[0]) * factor
    inside = s.between(F.col("q")[0] - reach, F.col("q")[2] + reach)
    boxes = counts.groupBy(*keys, "q", "trips").agg(
        F.min(F.when(inside, s)).alias("low"), F.max(F.when(inside, s)).alias("high")
    )
    return boxes.select(
        *keys,
        "trips",
        F.round(F.col("q")[0] / 60.0, 6).alias("q1"),
        F.round(F.col("q")[1] / 60.0, 6).alias("median"),
        F.round(F.col("q")[2] / 60.0, 6).alias("q3"),
        F.round(F.least(F.col("low").cast("double"), F.col("q")[0]) / 60.0, 6).alias("whisker_low"),
        F.round(F.greatest(F.col("high").cast("double"), F.col("q")[2]) / 60.0, 6).alias("whisker_high"),
    )


def box_by_rate_code(df: DataFrame) -> DataFrame:
    """Box statistics of the named rate codes that occur."""
    named = df.filter(F.col(S.RATE).isin(*map(float, trip.RATE_LABELS)))
    return box_stats(named, S.RATE).withColumn("rate_label", trip.rate_label(F.col(S.RATE)))


def iqr_bounds_of(df: DataFrame, columns: dict[str, Column], factor: float = 1.5) -> dict[str, tuple]:
    """Outlier bounds Q1 - k IQR and Q3 + k IQR of several numeric columns; nulls for a column without values."""
    bounds = {}
    for name, (q1, q3) in quantiles_of(df, columns, [0.25, 0.75]).items():
        bounds[name] = (None, None) if q1 is None else (q1 - factor * (q3 - q1), q3 + factor * (q3 - q1))
    return bounds


def iqr_bounds(df: DataFrame, column: Column, factor: float = 1.5) -> tuple[float | None, float | None]:
    """Outlier bounds of one column."""
    return iqr_bounds_of(df, {"x": column}, factor)["x"]


def plausible_speeds(df: DataFrame) -> DataFrame:
    speed = trip.implied_speed(F.col(S.DISTANCE), F.col(S.TARGET))
    return df.withColumn("speed_mph", speed).filter((F.col("speed_mph") > 0) & (F.col("speed_mph") <= S.MAX_SPEED_MPH))


def average_speed(df: DataFrame) -> DataFrame:
    """Mean and median of the plausible implied speeds."""
    speeds = plausible_speeds(df)
    median = exact_quantiles(speeds, F.col("speed_mph"), [0.5])[0]
    return speeds.agg(
        F.count(F.lit(1)).alias("trips"), F.avg("speed_mph").alias("mean_mph"), F.lit(median).alias("median_mph")
    )
