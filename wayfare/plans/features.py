"""Leak-free features: fit lookups and scalars on training trips, apply them to any trips."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare import schema as S
from wayfare import session
from wayfare.functions import trip
from wayfare.functions.time import with_cyclic_features, with_time_features
from wayfare.operators import lookup, profiling

# The 32 model inputs, in order.
FULL_FEATURES = [
    "trip_distance",
    "log_distance",
    "passenger_count",
    "fare_amount",
    "RatecodeID",
    "payment_type",
    "PULocationID",
    "DOLocationID",
    "same_zone_flag",
    "pu_borough",
    "do_borough",
    "cross_borough_flag",
    "pu_zone_rank",
    "do_zone_rank",
    "hour",
    "day_of_week",
    "month",
    "is_weekend",
    "is_rush_hour",
    "is_night",
    "hour_sin",
    "hour_cos",
    "dow_sin",
    "dow_cos",
    "month_sin",
    "month_cos",
    "baseline_duration",
    "route_mean_duration",
    "route_median_duration",
    "distance_x_rush",
    "distance_x_weekend",
    "distance_x_hour",
]
BOROUGH_FEATURES = ["pu_borough", "do_borough", "cross_borough_flag"]
SHORT_FEATURES = [c for c in FULL_FEATURES if c not in BOROUGH_FEATURES]


def feature_set(name: str = "full", with_fare: bool = True) -> list[str]:
    """The 32 full or 29 short inputs. A fare is only known after the trip, so it can be left out."""
    columns = {"full": FULL_FEATURES, "short": SHORT_FEATURES}[name]
    return [c for c in columns if with_fare or c != S.FARE]


@dataclass(frozen=True)
class Artifacts:
    """What training trips teach: route statistics, zone trip counts and two scalars."""

    routes: DataFrame
    zone_profile: DataFrame
    global_mean: float
    avg_speed_mph: float

    def scalars(self, spark: SparkSession) -> DataFrame:
        return session.literal_rows(spark, [(float(self.global_mean), float(self.avg_speed_mph))], "global_mean double, avg_speed_mph double"
        )

    def save(self, path: str) -> None:
        """One versioned directory: routes, zone profile and scalars as parquet tables."""
        self.routes.write.mode("overwrite").parquet(f"{path}/routes")
        self.zone_profile.write.mode("overwrite").parquet(f"{path}/zone_profile")
        self.scalars(self.routes.sparkSession).coalesce(1).write.mode("overwrite").parquet(f"{path}/scalars")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Artifacts":
        scalars = spark.read.parquet(f"{path}/scalars").first()
        return Artifacts(
            spark.read.parquet(f"{path}/routes"),
            spark.read.parquet(f"{path}/zone_profile"),
            scalars.global_mean,
            S.DEFAULT_SPEED_MPH if scalars.avg_speed_mph is None else scalars.avg_speed_mph,
        )


def route_seconds(train: DataFrame) -> DataFrame:
    """Training trips per (pickup zone, drop-off zone, whole second).

    The only shuffle of the training table: counts merge map-side, so a route with a third of all
    trips sends at most 10,741 rows per task. Every fitted value is read from this table.
    """
    return profiling.second_counts(train, S.PU, S.DO)


def route_stats(counts: DataFrame, min_route_count: int = S.MIN_ROUTE_COUNT) -> DataFrame:
    """Mean, median, sample std and trips of each route with enough support."""
    s, n = F.col(S.SECONDS), F.col("n")
    sums = counts.groupBy(S.PU, S.DO).agg(
        F.sum(n).alias("trips"),
        F.sum(s * n).alias("total_s"),
        F.sum((s * s).cast("decimal(20,0)") * n).alias("squares"),
        F.percentile(s, 0.5, n).alias("median_s"),
    )
    return sums.filter(F.col("trips") >= min_route_count).select(
        S.PU,
        S.DO,
        profiling.mean_minutes(F.col("total_s"), F.col("trips")).alias("route_mean_duration"),
        (F.col("median_s") / 60.0).alias("route_median_duration"),
        profiling.sample_std_minutes(F.col("trips"), F.col("total_s"), F.col("squares")).alias("route_std_duration"),
        "trips",
    )


def zone_counts(counts: DataFrame) -> DataFrame:
    """Training pickups and drop-offs of every zone, at most one row per zone."""
    ends = F.inline(
        F.array(
            F.struct(F.col(S.PU).alias("LocationID"), F.col("n").alias("pickups"), F.lit(0).cast("bigint").alias("dropoffs")),
            F.struct(F.col(S.DO).alias("LocationID"), F.lit(0).cast("bigint").alias("pickups"), F.col("n").alias("dropoffs")),
        )
    )
    return counts.select(ends).groupBy("LocationID").agg(F.sum("pickups").alias("pickups"), F.sum("dropoffs").alias("dropoffs"))


def global_mean_minutes(counts: DataFrame) -> DataFrame:
    return counts.agg(
        profiling.mean_minutes(F.sum(F.col(S.SECONDS) * F.col("n")), F.sum("n")).alias("global_mean")
    )


def fit(
    train: DataFrame,
    path: str,
    zones: DataFrame | None = None,
    codes: dict[str, int] | None = None,
    min_route_count: int = S.MIN_ROUTE_COUNT,
    avg_speed_mph: float | None = None,
) -> Artifacts:
    """Fit on training trips and write the artifact tables under ``path``.

    The counts per route and second are written first, so a lost executor never repeats the pass
    over the training table. The speed is measured unless given; with no plausible trip it falls
    back to the fixed default.
    """
    spark = train.sparkSession
    route_seconds(train).write.mode("overwrite").parquet(f"{path}/route_seconds")
    counts = spark.read.parquet(f"{path}/route_seconds")
    if avg_speed_mph is None:
        avg_speed_mph = profiling.plausible_speeds(train).agg(F.avg("speed_mph")).first()[0]
    fitted = Artifacts(
        route_stats(counts, min_route_count),
        zone_profile(zone_counts(counts), zones, codes),
        global_mean_minutes(counts).first()[0],
        S.DEFAULT_SPEED_MPH if avg_speed_mph is None else avg_speed_mph,
    )
    fitted.save(path)
    return Artifacts.load(spark, path)


def zone_profile(counts: DataFrame, zones: DataFrame | None, codes: dict[str, int] | None = None) -> DataFrame:
    """Per zone: borough code and trip counts, zero where unknown."""
    if zones is None:
        return counts.withColumn("borough", F.lit(0))
    # one row per zone, even if the zone table repeats an id
    coded = zones.groupBy("LocationID").agg(F.max(trip.borough_code(F.col("Borough"), codes)).alias("borough"))
    joined = coded.join(counts, "LocationID", "full")
    return joined.select(
        "LocationID", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("borough", "pickups", "dropoffs")]
    )


def with_location_features(df: DataFrame, profile: DataFrame) -> DataFrame:
    """Borough codes, cross-borough flag and training trip counts of both ends.

    One profile per zone is joined once for each end, as a broadcast bounded by the zone domain.
    """
    pickup = profile.select(
        F.col("LocationID").alias(S.PU), F.col("borough").alias("pu_borough"), F.col("pickups").alias("pu_zone_rank")
    )
    dropoff = profile.select(
        F.col("LocationID").alias(S.DO), F.col("borough").alias("do_borough"), F.col("dropoffs").alias("do_zone_rank")
    )
    df = lookup.left_lookup(df, lookup.zone_keyed(pickup, S.PU), [S.PU], {"pu_borough": 0, "pu_zone_rank": 0})
    df = lookup.left_lookup(df, lookup.zone_keyed(dropoff, S.DO), [S.DO], {"do_borough": 0, "do_zone_rank": 0})
    return df.withColumns(
        {
            "same_zone_flag": trip.same_zone(F.col(S.PU), F.col(S.DO)),
            "cross_borough_flag": (F.col("pu_borough") != F.col("do_borough")).cast("int"),
        }
    )


def with_route_features(df: DataFrame, routes: DataFrame, global_mean: float) -> DataFrame:
    """Route mean and median; the global training mean for routes without support."""
    columns = ["route_mean_duration", "route_median_duration"]
    known = lookup.zone_keyed(routes.select(S.PU, S.DO, *columns), S.PU, S.DO)
    return lookup.left_lookup(df, known, [S.PU, S.DO], {c: global_mean for c in columns})


def route_coverage(df: DataFrame, routes: DataFrame) -> DataFrame:
    """Trips, trips on a known route, and their share in percent."""
    known = lookup.zone_keyed(routes.select(S.PU, S.DO, F.lit(True).alias("known")), S.PU, S.DO)
    joined = df.select(S.PU, S.DO).join(known, [S.PU, S.DO], "left")
    return joined.agg(
        F.count(F.lit(1)).alias("trips"),
        F.count("known").alias("matched"),
        F.round(F.count("known") * 100.0 / F.count(F.lit(1)), 4).alias("coverage_pct"),
    )


def apply(df: DataFrame, artifacts: Artifacts) -> DataFrame:
    """Every feature for trips or scoring requests: one chain for training, testing and serving.

    Narrow apart from three bounded broadcast lookups, so nothing is shuffled.
    """
    return (
        df.transform(with_time_features)
        .transform(with_cyclic_features)
        .transform(trip.with_distance_features, artifacts.avg_speed_mph)
        .transform(with_location_features, artifacts.zone_profile)
        .transform(with_route_features, artifacts.routes, artifacts.global_mean)
        .transform(trip.with_interactions)
    )


def matrix(df: DataFrame, columns: list[str], keep: list[str] = [S.TARGET]) -> DataFrame:
    """Model inputs as doubles with missing values at zero, plus the kept columns."""
    inputs = [F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(c) for c in columns]
    return df.select(*inputs, *[F.col(c) for c in keep if c not in columns])
