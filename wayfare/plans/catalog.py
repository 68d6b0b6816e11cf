"""Registered queries: every operator run over the whole test tables.

Each entry takes (spark, sf_dir) and returns a DataFrame. Floating-point outputs are rounded to a
fixed number of places, so that a second engine summing in another order agrees.
"""

from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare import schema as S
from wayfare import session
from wayfare.functions import requests as R
from wayfare.functions import time as calendar
from wayfare.functions import trip
from wayfare.models import boosting, evaluation, linear_search, pipelines, saved, scores, search, store
from wayfare.operators import impute as imputing
from wayfare.operators import metrics, profiling, quality, sampling, split
from wayfare.plans import features, prepare, report, scoring
from wayfare.plans.workspace import Workspace, workspace
from wayfare.sources import sinks, star_schema, trips, zones
from wayfare.streaming import scoring as streaming

QUERIES: dict = {}

# SQL-checkable predictors, by display name.
SIMPLE_MODELS = {
    "baseline": "baseline_duration",
    "route_mean": "route_mean_duration",
    "route_median": "route_median_duration",
}
PREDICTED = "route_mean_duration"
DRIFT_YEAR = 1998  # months before it are read without totals


def query(function):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(workspace(spark, sf_dir))

    QUERIES[function.__name__] = run
    return function


def rounded(df: DataFrame, places: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


def fractional(columns: list[str]) -> list[str]:
    """Inputs that are not whole numbers."""
    prefixes = ("trip_d", "log_", "fare", "baseline", "route", "distance_x", "hour_", "dow_", "month_")
    return [c for c in columns if c.startswith(prefixes)]


def with_keys(*columns: str) -> list[str]:
    return [S.PICKUP, S.DROPOFF, S.PU, S.DO, *columns]


def raw_with_duration(ws: Workspace) -> DataFrame:
    return ws.raw().select(*S.TRIP_COLUMNS).transform(trip.with_duration)


def trip_key() -> Column:
    """Text that tells cleaned trips apart, from integers only."""

    def whole(column, scale):
        return F.rint(F.col(column) * scale).cast("bigint")

    return F.concat_ws(
        "|",
        calendar.epoch_seconds(F.col(S.PICKUP)),
        S.SECONDS,
        S.PU,
        S.DO,
        whole(S.DISTANCE, 100),
        whole(S.TOTAL, 100_000),
        whole(S.PASSENGERS, 1),
        whole(S.RATE, 1),
        whole(S.PAYMENT, 1),
        S.FLAG,
    )


# ---- sources and sinks


@query
def scan_trips(ws):
    """Every catalogued month that exists, chosen columns."""
    return trips.read_trip_table(ws.spark, ws.path("raw"), ws.months, with_keys(S.DISTANCE, S.FARE))


@query
def scan_months(ws):
    """Monthly files through the file reader, provenance from their names; one listed month does not exist."""
    root, months = session.scratch_path(ws.spark, "monthly"), ws.months

    def write(month):
        mine = (F.col(S.SOURCE_YEAR) == month[0]) & (F.col(S.SOURCE_MONTH) == month[1])
        ws.raw().filter(mine).select(*S.TRIP_COLUMNS).write.parquet(trips.month_paths(root, [month])[0])

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(write, months))
    missing = (months[-1][0] + 1, 1)
    found = trips.read_months(ws.spark, root, [*months, missing], uniform=True, with_source=True)
    return found.groupBy(S.SOURCE_YEAR, S.SOURCE_MONTH).agg(F.count(F.lit(1)).alias("trips"), F.count(S.PASSENGERS).alias("with_passengers"))


@query
def scan_source_month(ws):
    """Provenance read back from file paths."""
    months = trips.source_month_columns(trips.MONTH_IN_PARTITION)
    sourced = ws.raw().drop(S.SOURCE_YEAR, S.SOURCE_MONTH).withColumns(months)
    return sourced.groupBy(S.SOURCE_YEAR, S.SOURCE_MONTH).agg(F.count(F.lit(1)).alias("trips"))


@query
def union_months(ws):
    """Earlier and later months whose columns drifted: no totals, then integer passengers."""
    early, late = ([m for m in ws.months if (m[0] < DRIFT_YEAR) == first] for first in (True, False))
    before = trips.read_trip_table(ws.spark, ws.path("raw"), early, S.TRIP_COLUMNS).drop(S.TOTAL)
    after = trips.read_trip_table(ws.spark, ws.path("raw"), late, S.TRIP_COLUMNS)
    return trips.union_months([before, after.withColumn(S.PASSENGERS, F.col(S.PASSENGERS).cast("int"))])


@query
def zone_volumes(ws):
    """The zone table written as CSV, read back, and met with trips per pickup zone."""
    path = session.scratch_path(ws.spark, "zones.csv")
    zones.write_zones(ws.zones(), path)
    counts = profiling.value_counts(ws.clean(), S.PU).withColumnRenamed(S.PU, "LocationID")
    return counts.join(zones.read_zones(ws.spark, path), "LocationID", "left")


@query
def roundtrip_parquet(ws):
    """Cleaned trips through the partitioned sink and back."""
    return ws.clean_unfilled().select(*S.TRIP_COLUMNS, "year", "month")


@query
def typed_trips(ws):
    """Cleaned trips of both periods in the narrow export types."""
    compact = prepare.compact_types(ws.clean())
    return compact.select(*S.TRIP_COLUMNS, S.TARGET)


# ---- cleaning


@query
def duration(ws):
    return rounded(raw_with_duration(ws).select(*with_keys(S.TARGET, S.SECONDS)), 6, S.TARGET)


@query
def clean_trips(ws):
    """Every rule of the full variant, duplicates kept."""
    kept = quality.apply_rules(raw_with_duration(ws), quality.rules(quality.FULL_RULES))
    return kept.select(*S.TRIP_COLUMNS)


@query
def clean_trips_short(ws):
    """The short variant: its rule order, no duplicate removal, zeros for gaps."""
    kept = quality.apply_rules(raw_with_duration(ws), quality.rules(quality.SHORT_RULES))
    return imputing.zero_fill(kept, [S.PASSENGERS, S.RATE, S.PAYMENT]).select(*S.TRIP_COLUMNS)


@query
def dedup(ws):
    return prepare.prepare(ws.raw()).select(*S.TRIP_COLUMNS)


@query
def filter_audit(ws):
    return quality.filter_audit(raw_with_duration(ws))


@query
def filter_audit_short(ws):
    return quality.filter_audit(raw_with_duration(ws), quality.rules(quality.SHORT_RULES), dedup=False)


@query
def wrong_year(ws):
    return quality.wrong_year(ws.raw()).select(*with_keys(S.SOURCE_YEAR, S.SOURCE_MONTH))


@query
def profile(ws):
    return quality.profile(ws.raw().select(*S.TRIP_COLUMNS))


@query
def null_counts(ws):
    """Missing values before and after imputation."""
    before = quality.null_counts(ws.clean_unfilled().select(*S.TRIP_COLUMNS)).withColumn("stage", F.lit("before"))
    after = quality.null_counts(ws.clean().select(*S.TRIP_COLUMNS)).withColumn("stage", F.lit("after"))
    return before.unionByName(after)


@query
def impute(ws):
    """Fills fitted on training trips, applied to all."""
    return ws.clean().select(*with_keys(S.PASSENGERS, S.RATE, S.PAYMENT, S.FLAG))


@query
def time_split(ws):
    train, test = split.by_cutoff(ws.clean(), star_schema.CUTOFF)
    labelled = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return labelled.groupBy("part").agg(
        F.count(F.lit(1)).alias("trips"),
        F.min(S.PICKUP).alias("first_pickup"),
        F.max(S.PICKUP).alias("last_pickup"),
        F.sum(S.SECONDS).cast("bigint").alias("total_seconds"),
    )


@query
def iqr_bounds(ws):
    """Outlier bounds of three columns, with the number of trips outside."""
    train, names = ws.train(), [S.SECONDS, S.DISTANCE, S.FARE]
    bounds = profiling.iqr_bounds_of(train, {c: F.col(c) for c in names})
    outside = [F.count_if((F.col(c) < bounds[c][0]) | (F.col(c) > bounds[c][1])).alias(c) for c in names]
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.round(F.lit(bounds[c][0]).cast("double"), 6).alias("lower_bound"),
            F.round(F.lit(bounds[c][1]).cast("double"), 6).alias("upper_bound"),
            F.col(c).alias("outliers"),
        )
        for c in names
    ]
    return train.agg(*outside).select(F.inline(F.array(*rows)))


@query
def iqr_outliers(ws):
    """Raw trips whose distance falls outside the bounds of the cleaned training trips."""
    raw = ws.raw()  # staged before cleaning, which then reads it
    low, high = profiling.iqr_bounds(ws.train(), F.col(S.DISTANCE))
    outside = (F.col(S.DISTANCE) < low) | (F.col(S.DISTANCE) > high)
    return raw.filter(outside).select(*with_keys(S.DISTANCE))


# ---- features


@query
def time_features(ws):
    timed = calendar.with_time_features(ws.clean())
    names = list(calendar.calendar_columns(F.col(S.PICKUP)))
    labels = {"day_label": calendar.day_label(F.col("day_of_week")), "month_label": calendar.month_label(F.col("month"))}
    # the table's own year and month partition columns are replaced by the pickup's
    return timed.select(*with_keys(*names)).withColumns(labels)


@query
def cyclic(ws):
    timed = calendar.with_cyclic_features(calendar.with_time_features(ws.clean()))
    names = [f"{c}_{f}" for c in calendar.CYCLES for f in ("sin", "cos")]
    return rounded(timed.select(*with_keys(*names)), 9, *names)


@query
def distance_features(ws):
    df = trip.with_distance_features(ws.clean(), S.DEFAULT_SPEED_MPH)
    names = ["log_distance", "baseline_duration"]
    return rounded(df.select(*with_keys(S.DISTANCE, *names)), 9, *names)


@query
def location_features(ws):
    df = features.with_location_features(ws.clean(), ws.artifacts.zone_profile)
    names = ["same_zone_flag", "pu_borough", "do_borough", "cross_borough_flag", "pu_zone_rank", "do_zone_rank"]
    return df.select(*with_keys(*names))


@query
def zone_popularity(ws):
    """Training pickups and drop-offs per zone."""
    return features.zone_counts(features.route_seconds(ws.train()))


@query
def route_stats(ws):
    stats = features.route_stats(features.route_seconds(ws.train()))
    return rounded(stats, 6, "route_mean_duration", "route_median_duration", "route_std_duration")


@query
def route_stats_short(ws):
    """Support of 30 trips, as in the short variant."""
    stats = features.route_stats(features.route_seconds(ws.train()), min_route_count=30)
    return rounded(stats, 6, "route_mean_duration", "route_median_duration", "route_std_duration")


@query
def global_mean(ws):
    return rounded(features.global_mean_minutes(features.route_seconds(ws.train())), 9, "global_mean")


@query
def route_features(ws):
    df = features.with_route_features(ws.clean(), ws.artifacts.routes, ws.artifacts.global_mean)
    names = ["route_mean_duration", "route_median_duration"]
    return rounded(df.select(*with_keys(*names)), 6, *names)


@query
def route_coverage(ws):
    train = features.route_coverage(ws.train(), ws.artifacts.routes).withColumn("part", F.lit("train"))
    return train.unionByName(features.route_coverage(ws.test(), ws.artifacts.routes).withColumn("part", F.lit("test")))


@query
def interactions(ws):
    df = trip.with_interactions(calendar.with_time_features(ws.clean()))
    names = ["distance_x_rush", "distance_x_weekend", "distance_x_hour"]
    return rounded(df.select(*with_keys(*names)), 6, *names)


@query
def feature_matrix(ws):
    """All 32 inputs and the target, for training and test trips."""
    columns = features.feature_set("full")
    train = features.matrix(ws.train_features(), columns).withColumn("part", F.lit("train"))
    test = features.matrix(ws.test_features(), columns).withColumn("part", F.lit("test"))
    return rounded(train.unionByName(test), 6, *fractional(columns), S.TARGET)


@query
def feature_matrix_short(ws):
    """The 29 inputs of the short variant, for training and test trips."""
    columns = features.feature_set("short")
    return rounded(features.matrix(ws.featured(ws.clean()), columns), 6, *fractional(columns), S.TARGET)


# ---- profiling


@query
def duration_summary(ws):
    return profiling.duration_summary(raw_with_duration(ws))


@query
def describe_duration(ws):
    return profiling.describe_duration(ws.train())


@query
def avg_by_hour(ws):
    return profiling.mean_duration_by(calendar.with_time_features(ws.train()), "hour")


@query
def avg_by_dow(ws):
    by_day = profiling.mean_duration_by(calendar.with_time_features(ws.train()), "day_of_week")
    return by_day.withColumn("day_label", calendar.day_label(F.col("day_of_week")))


@query
def avg_by_month(ws):
    by_month = profiling.mean_duration_by(calendar.with_time_features(ws.train()), "month")
    return by_month.withColumn("month_label", calendar.month_label(F.col("month")))


@query
def heatmap_hour_dow(ws):
    return profiling.hour_by_day(calendar.with_time_features(ws.train()))


@query
def heatmap_hour_dow_count(ws):
    return profiling.hour_by_day(calendar.with_time_features(ws.train()), "count")


@query
def peak_hours(ws):
    by_hour = profiling.mean_duration_by(calendar.with_time_features(ws.train()), "hour")
    return profiling.extremes(by_hour, "hour", "mean_minutes")


@query
def corr_matrix(ws):
    return rounded(profiling.correlation_matrix(ws.train()), 6, "correlation")


@query
def corr_pair(ws):
    return ws.train().agg(F.round(F.corr(S.DISTANCE, S.TARGET), 6).alias("correlation"))


@query
def hist_duration(ws):
    return profiling.histogram(ws.train(), F.col(S.SECONDS))


@query
def hist_speed(ws):
    return profiling.histogram(profiling.plausible_speeds(ws.train()), F.col("speed_mph"))


@query
def box_duration(ws):
    return profiling.box_stats(ws.train())


@query
def box_by_ratecode(ws):
    return profiling.box_by_rate_code(ws.train())


@query
def avg_speed(ws):
    return rounded(profiling.average_speed(ws.train()), 6, "mean_mph", "median_mph")


@query
def top_pickup_zones(ws):
    return profiling.top_zones(ws.train(), S.PU, ws.zones())


@query
def top_dropoff_zones(ws):
    return profiling.top_zones(ws.train(), S.DO, ws.zones())


@query
def sample_trips(ws):
    """A fixed-size sample of training trips for plotting."""
    sample = sampling.sample_rows(ws.train(), 10_000, trip_key())
    return rounded(sample.select(*with_keys(S.DISTANCE, S.TARGET)), 6, S.TARGET)


# ---- evaluation


@query
def ts_split(ws):
    """Expanding-window blocks of the training trips."""
    blocks = split.with_time_blocks(ws.train(), 5)
    return blocks.select(*with_keys(S.DISTANCE, S.TOTAL, S.PASSENGERS, S.RATE, S.PAYMENT, S.FLAG, "block"))


@query
def ts_split_short(ws):
    """The same blocks for trips read without the total, as the short variant reads them."""
    blocks = split.with_time_blocks(ws.train().drop(S.TOTAL), 5)
    return blocks.select(*with_keys(S.DISTANCE, S.FARE, S.PASSENGERS, S.RATE, S.PAYMENT, S.FLAG, "block"))


@query
def ts_split_drifted(ws):
    """Blocks of trips whose early months have no total."""
    total = F.when(F.year(S.PICKUP) >= DRIFT_YEAR, F.col(S.TOTAL))
    blocks = split.with_time_blocks(ws.train().withColumn(S.TOTAL, total), 5)
    return blocks.select(*with_keys(S.DISTANCE, S.TOTAL, S.PASSENGERS, S.RATE, S.PAYMENT, S.FLAG, "block"))


@query
def clip(ws):
    """Predictions held at zero for evaluation and inside the served range for serving."""
    signed = F.col("baseline_duration") - 60
    df = trip.with_distance_features(ws.clean(), S.DEFAULT_SPEED_MPH).withColumns(
        {"evaluated": trip.clip(signed, low=0), "served": trip.clip(signed, *scoring.SERVED_RANGE)}
    )
    return rounded(df.select(*with_keys("evaluated", "served")), 6, "evaluated", "served")


def with_prediction_errors(ws, trips_to_score: DataFrame | None = None) -> DataFrame:
    featured = ws.test_features() if trips_to_score is None else ws.featured(trips_to_score)
    return trip.with_errors(featured, S.TARGET, PREDICTED)


@query
def error_columns(ws):
    names = ["error_minutes", "abs_error", "pct_error"]
    return rounded(with_prediction_errors(ws).select(*with_keys(*names)), 6, *names)


@query
def baseline_metrics(ws):
    return metrics.evaluate_models(ws.test_features(), S.TARGET, SIMPLE_MODELS)


@query
def leaderboard(ws):
    return metrics.leaderboard(metrics.evaluate_models(ws.test_features(), S.TARGET, SIMPLE_MODELS))


@query
def success_criteria(ws):
    board = metrics.leaderboard(metrics.evaluate_models(ws.test_features(), S.TARGET, SIMPLE_MODELS))
    return metrics.success_criteria(board)


@query
def model_report(ws):
    """The markdown report, through the text sink and back."""
    board = metrics.leaderboard(metrics.evaluate_models(ws.test_features(), S.TARGET, SIMPLE_MODELS))
    path = session.scratch_path(ws.spark, "report")
    report.write_report(board, path)
    return ws.spark.read.text(path)


@query
def cv_baseline(ws):
    """Expanding-window scores of the constant-speed baseline, mean and spread over five folds."""
    blocks = split.with_time_blocks(ws.train(), 5).filter("block > 0")
    df = trip.with_distance_features(blocks, S.DEFAULT_SPEED_MPH)
    folds = metrics.evaluate_models(df, S.TARGET, {"baseline": "baseline_duration"}, by=["block"], round_to=None)
    return metrics.fold_summary(folds, ["model"])


@query
def residual_summary(ws):
    return metrics.residual_summary(ws.test_features(), S.TARGET, PREDICTED)


@query
def hist_residual(ws):
    return profiling.histogram(ws.test_features(), F.round(F.col(PREDICTED) - F.col(S.TARGET), 6))


@query
def err_by_hour(ws):
    return metrics.mean_error_by(with_prediction_errors(ws), "hour")


@query
def err_by_dow(ws):
    return metrics.mean_error_by(with_prediction_errors(ws), "day_of_week")


@query
def err_by_distance(ws):
    banded = with_prediction_errors(ws).withColumns(
        {"band": trip.distance_band(F.col(S.DISTANCE)), "band_order": trip.distance_band_order(F.col(S.DISTANCE))}
    )
    return metrics.mean_error_by(banded.filter(F.col("band").isNotNull()), "band", "band_order")


@query
def err_extremes(ws):
    return metrics.error_extremes(with_prediction_errors(ws))


@query
def err_sample(ws):
    """Actual, predicted and absolute error of a fixed-size sample."""
    sample = with_prediction_errors(ws, sampling.sample_rows(ws.test(), 5_000, trip_key()))
    names = [S.TARGET, PREDICTED, "abs_error"]
    return rounded(sample.select(*with_keys(*names)), 6, *names)


EXPORT_ROWS = 100_000  # fixed size of the export


@query
def prediction_export(ws):
    """Inputs and results of a sample of test trips, through the CSV sink and back."""
    return exported(ws, EXPORT_ROWS)


@query
def prediction_export_5k(ws):
    """The same export of fewer trips than there are, so that the sample is drawn."""
    return exported(ws, 5000)


def exported(ws, rows: int) -> DataFrame:
    columns = features.feature_set("short")
    scored = with_prediction_errors(ws, sampling.sample_rows(ws.test(), rows, trip_key())).withColumns(
        {"predicted_duration": F.col(PREDICTED), "baseline_pred": F.col("baseline_duration")}
    )
    names = ["predicted_duration", "baseline_pred", "error_minutes", "abs_error"]
    export = features.matrix(scored, columns, [S.TARGET, *names]).withColumnRenamed(S.TARGET, "actual_duration")
    path = session.scratch_path(ws.spark, "predictions.csv")
    sinks.write_csv(rounded(export, 6, *export.columns), path)
    return ws.spark.read.schema(export.schema).option("header", True).csv(path)


# ---- scoring


def request_batch(ws) -> DataFrame:
    return star_schema.requests(star_schema.table(ws.spark, ws.sf_dir, "events"))


@query
def score_validate(ws):
    """Coerced requests with the reason each bad one was rejected."""
    checked = R.validate(request_batch(ws))
    names = ["event_id", *R.REQUEST_TO_TRIP, "pickup_ts", "reject_reason"]
    return checked.select(*names)


@query
def score_validate_form(ws):
    """The same with a distance-based fare where none is given."""
    checked = R.validate(request_batch(ws), estimate_fare=True)
    return checked.select("event_id", "trip_distance", "fare_amount", "reject_reason")


def valid_requests(ws) -> DataFrame:
    return R.validate(request_batch(ws)).filter(F.col("reject_reason").isNull())


@query
def score_features(ws):
    """The training feature chain applied to requests."""
    featured = features.apply(R.as_trips(valid_requests(ws)), ws.artifacts)
    columns = features.feature_set("full")
    return rounded(features.matrix(featured, columns, ["event_id"]), 6, *fractional(columns))


@query
def score_baseline(ws):
    """Batch scoring with the route mean as predictor."""
    predictor = scoring.column_predictor(PREDICTED)
    return scoring.score(valid_requests(ws), ws.artifacts, predictor, "route_mean", ["event_id"])


@query
def eta(ws):
    return scoring.arrivals(score_baseline(ws))


@query
def stream_score_baseline(ws):
    """Stream scoring with the route mean as predictor; rejects are filed apart and counted in."""
    return run_stream(ws, scoring.column_predictor(PREDICTED), "route_mean")


def run_stream(ws, predictor, name: str) -> DataFrame:
    """Scored and rejected requests of one available-now run over the events."""
    schema = star_schema.table(ws.spark, ws.sf_dir, "events").schema
    # a file source wants a directory or a glob, not a plain file
    stream = star_schema.requests(streaming.read_stream(ws.spark, f"{ws.sf_dir}/event[s].parquet", schema))
    root = session.scratch_path(ws.spark, "stream")
    streaming.run_to_end(
        streaming.score_stream(
            stream, ws.artifacts, predictor, name, f"{root}/scored", f"{root}/rejects", f"{root}/checkpoint", ["event_id"]
        )
    )
    scored = ws.spark.read.parquet(f"{root}/scored").drop("batch")
    rejects = ws.spark.read.parquet(f"{root}/rejects").drop("batch")
    return scored.unionByName(rejects, allowMissingColumns=True)


# ---- models

COLUMNS = features.feature_set("full")
def measured(ws, **models) -> DataFrame:
    """Test metrics of fitted models."""
    return evaluation.evaluate_fitted(ws.test_matrix(), models, baseline=False)


def fitted_ols(ws, columns: list[str] = COLUMNS):
    return ws.model(f"linear_regression_{len(columns)}", lambda: pipelines.linear_regression(columns).fit(ws.train_matrix()))


def fitted_ridge(ws, columns: list[str] = COLUMNS, alpha: float | None = None):
    def fit():
        train, penalty = ws.train_matrix(), alpha
        if penalty is None:
            moments = linear_search.block_moments(train, columns)
            penalty = linear_search.best_alpha(linear_search.grid_scores(moments, pipelines.FULL_ALPHAS))
        rows, deviation = train.agg(F.count(F.lit(1)), F.stddev_pop(S.TARGET)).first()
        return pipelines.ridge_regression(columns, penalty, rows, deviation).fit(train)

    return ws.model(f"ridge_regression_{len(columns)}", fit)


@query
def ols_1d(ws):
    """Least squares of duration on distance alone."""
    moments = linear_search.block_moments(ws.train_matrix(), [S.DISTANCE])
    total = sum(list(moments.values())[1:], list(moments.values())[0])
    line = linear_search.solve(total)
    return ws.train_matrix().agg(
        F.count(F.lit(1)).alias("rows"),
        F.round(F.lit(float(line.weights[0])), 9).alias("slope"),
        F.round(F.lit(line.intercept), 9).alias("intercept"),
    )


@query
def cv_ols_1d(ws):
    """Scores of that fit on each expanding-window fold."""
    moments = linear_search.block_moments(ws.train_matrix(), [S.DISTANCE])
    folds = linear_search.fold_metrics(ws.train_matrix(), [S.DISTANCE], moments)
    return rounded(folds.select("block", "rows", "RMSE", "MAE", "R2"), 6, "RMSE", "MAE", "R2")


@query
def ridge_grid_1d(ws):
    """Mean validation error of each penalty for duration on distance alone."""
    moments = linear_search.block_moments(ws.train_matrix(), [S.DISTANCE])
    return grid_table(ws, linear_search.grid_scores(moments, pipelines.FULL_ALPHAS))


@query
def ridge_grid_short_1d(ws):
    """The same with the penalties of the short variant."""
    moments = linear_search.block_moments(ws.train_matrix(), [S.DISTANCE])
    return grid_table(ws, linear_search.grid_scores(moments, pipelines.SHORT_ALPHAS))


def grid_table(ws, scores: list[tuple[float, float]]) -> DataFrame:
    best = linear_search.best_alpha(scores)
    rows = [(alpha, round(rmse, 6), alpha == best) for alpha, rmse in scores]
    return session.literal_rows(ws.spark, rows, "alpha double, RMSE_mean double, is_best boolean")


@query
def scaled_features(ws):
    """Mean and sample deviation of the scaled inputs over the training rows."""
    scaled = pipelines.scaled_features(COLUMNS).fit(ws.train_matrix()).transform(ws.train_matrix())
    values = scaled.select(F.posexplode(vector_to_array("scaled")).alias("position", "value"))
    return values.groupBy("position").agg(
        F.round(F.abs(F.avg("value")), 6).alias("abs_mean"), F.round(F.stddev_samp("value"), 6).alias("std")
    )


@query
def ols(ws):
    return measured(ws, linear_regression=fitted_ols(ws))


@query
def ridge_grid(ws):
    """Mean validation error of each penalty, all inputs."""
    moments = linear_search.block_moments(ws.train_matrix(), COLUMNS)
    return grid_table(ws, linear_search.grid_scores(moments, pipelines.FULL_ALPHAS))


@query
def ridge(ws):
    """The best penalty of the grid, refitted on all training rows."""
    return measured(ws, ridge_regression=fitted_ridge(ws))


@query
def cv_scores(ws):
    """Validation mean and spread of the baseline and the linear models with the chosen penalty, through the JSON sink and back."""
    return scores_document(ws, COLUMNS)


@query
def cv_scores_1d(ws):
    """The same document for models of distance alone."""
    return scores_document(ws, [S.DISTANCE])


def one_input_folds(ws, columns: list[str]) -> tuple[float, DataFrame]:
    """The chosen penalty, and the fold scores of the baseline and the linear models."""
    train = ws.train_matrix()
    moments = linear_search.block_moments(train, columns)
    alpha = linear_search.best_alpha(linear_search.grid_scores(moments, pipelines.FULL_ALPHAS))
    folds = linear_search.fold_metrics(train, columns, moments).withColumn("model", F.lit("linear_regression"))
    ridge_folds = linear_search.fold_metrics(train, columns, moments, alpha).withColumn("model", F.lit("ridge_regression"))
    held = trip.with_distance_features(train.filter(F.col("block") > 0), S.DEFAULT_SPEED_MPH)
    base = metrics.evaluate_models(held, S.TARGET, {"baseline": "baseline_duration"}, ["block"], None)
    names = ["model", "RMSE", "MAE", "R2"]
    return alpha, folds.select(*names).unionByName(ridge_folds.select(*names)).unionByName(base.select(*names))


def scores_document(ws, columns: list[str]) -> DataFrame:
    alpha, every = one_input_folds(ws, columns)
    summary = metrics.fold_summary(every, ["model"]).withColumn("best_alpha", F.when(F.col("model") == "ridge_regression", F.lit(alpha)))
    path = session.scratch_path(ws.spark, "scores.json")
    sinks.write_json(summary, path)
    return ws.spark.read.schema(summary.schema).json(path)


@query
def model_roundtrip(ws):
    """Metrics of a model before saving and after loading, with its own input count."""
    root = session.scratch_path(ws.spark, "models")
    model = fitted_ols(ws)
    store.save_model(model, root, "linear_regression")
    loaded = store.load_model(ws.spark, root, "linear_regression")
    return measured(ws, saved=model, loaded=loaded).withColumn("inputs", F.lit(len(store.input_columns(loaded))))


@query
def model_leaderboard(ws):
    """Saved linear models beside the baseline: metrics, gains and the best one; a missing model is skipped."""
    root = session.scratch_path(ws.spark, "models")
    store.save_model(fitted_ols(ws), root, "linear_regression")
    store.save_model(fitted_ridge(ws), root, "ridge_regression")
    names = ["linear_regression", "ridge_regression", "no_such_model"]
    return metrics.leaderboard(evaluation.evaluate_saved(ws.test_matrix(), root, names))


@query
def score_batch(ws):
    """Batch scoring of requests with ridge regression."""
    predictor = scoring.model_predictor(fitted_ridge(ws), COLUMNS)
    return scoring.score(valid_requests(ws), ws.artifacts, predictor, "ridge_regression", ["event_id"])


@query
def stream_score(ws):
    """Stream scoring of the same requests with linear regression."""
    return run_stream(ws, scoring.model_predictor(fitted_ols(ws), COLUMNS), "linear_regression")


# ---- models of one input, which SQL can check

ONE = [S.DISTANCE]
ALPHA_1D = 10.0


@query
def model_leaderboard_1d(ws):
    """The library's own linear and ridge pipelines on distance alone, saved, loaded and measured beside the baseline."""
    root = session.scratch_path(ws.spark, "models")
    store.save_model(fitted_ols(ws, ONE), root, "linear_regression")
    store.save_model(fitted_ridge(ws, ONE, ALPHA_1D), root, "ridge_regression")
    return metrics.leaderboard(evaluation.evaluate_saved(ws.test_matrix(), root, ["linear_regression", "ridge_regression"]))


@query
def score_batch_1d(ws):
    predictor = scoring.model_predictor(fitted_ols(ws, ONE), ONE)
    return scoring.score(valid_requests(ws), ws.artifacts, predictor, "linear_regression", ["event_id"])


@query
def stream_score_1d(ws):
    return run_stream(ws, scoring.model_predictor(fitted_ols(ws, ONE), ONE), "linear_regression")


@query
def gbt_stump(ws):
    """One boosting round of depth one on the hour: the duration it predicts for each hour of the training trips."""
    hours = ["hour"]
    trees = ws.model("gbt_stump", lambda: pipelines.boosted_trees(hours, maxIter=1, maxDepth=1, stepSize=0.2).fit(ws.train_matrix()))
    counts = ws.train_matrix().groupBy("hour").agg(F.count(F.lit(1)).alias("trips"))
    return trees.transform(counts).select("hour", "trips", F.round("prediction", 6).alias("predicted"))


@query
def stump_importance(ws):
    """Gain and splits of its one input, read from the saved trees of the same stump grown by rounds."""
    model_of_hours(ws, "stump", STUMP)
    found = saved.top_importance(ws.spark, boosting.part_folders(ws.path("boosted/stump")), 25)
    return rounded(found, 4, "gain", "importance")


# ---- boosting by rounds, on one input where SQL can follow it

STUMP = boosting.Settings(rounds=1, rate=0.2, depth=1, row_share=1.0, column_share=1.0, l1=0.0, l2=0.0, patience=None, bins=32)
PATIENT = replace(STUMP, rounds=24, rate=0.3, patience=3)
PENALISED = replace(STUMP, rounds=4, rate=0.5, l1=40.0, l2=25.0)


def model_of_hours(ws, name: str, settings: boosting.Settings):
    return boosting.fit(ws.train_matrix(), ["hour"], settings, ws.path(f"boosted/{name}"))


@query
def boosting_patience(ws):
    """Held-out error after every round of stumps on the hour, until three rounds brought no lower one; the rounds that are kept."""
    curve = boosting.error_curve(model_of_hours(ws, "patient", PATIENT), ws.spark)
    return rounded(curve, 6, "RMSE")


@query
def boosting_penalties(ws):
    """Duration that stumps on the hour predict for each hour when leaf sums are thresholded and leaf counts enlarged."""
    counts = ws.train_matrix().groupBy("hour").agg(F.count(F.lit(1)).alias("trips"))
    scored = model_of_hours(ws, "penalised", PENALISED).transform(counts)
    return scored.select("hour", "trips", F.round("prediction", 6).alias("predicted"))


@query
def tree_importance(ws):
    """Gain and splits of each input of one saved tree of depth two on hour, weekday and passengers."""
    columns = ["hour", "day_of_week", S.PASSENGERS]
    boosting.fit(ws.train_matrix(), columns, replace(STUMP, depth=2), ws.path("boosted/tree"))
    return rounded(saved.top_importance(ws.spark, boosting.part_folders(ws.path("boosted/tree")), 25), 4, "gain", "importance")


@query
def search_plan(ws):
    """Work list of the random search: the points drawn, and for every fold the rows to fit and those in a round's sample."""
    drawn = search.points(ws.spark, pipelines.BOOSTING_SPACE, pipelines.SEARCH_DRAWS)
    train = ws.train().transform(split.with_time_blocks)
    place = F.conv(F.substring(F.md5(F.concat_ws("|", trip_key(), F.lit("42"))), 1, 8), 16, 10).cast("long") % boosting.SHARES
    shares = pipelines.BOOSTING_SPACE["subsample"]
    within = [F.sum((place < int(x * boosting.SHARES + 0.5)).cast("long")).alias(f"s{i}") for i, x in enumerate(shares)]
    counted = train.groupBy("block").agg(F.count(F.lit(1)).alias("rows"), *within)  # a row per block
    past = counted.alias("held").join(counted.alias("past"), F.col("past.block") < F.col("held.block"))
    folds = past.groupBy(F.col("held.block").alias("block")).agg(
        F.sum("past.rows").alias("rows_fitted"), F.first("held.rows").alias("rows_held"), F.array(*[F.sum(f"past.s{i}") for i in range(len(shares))]).alias("sampled")
    )
    at = F.array_position(F.array(*[F.lit(x) for x in shares]), F.col("subsample"))
    listed = folds.agg(F.collect_list(F.struct("*")).alias("folds")).first()["folds"]  # a row per fold
    entries = [F.struct(F.lit(f.block).alias("block"), F.lit(f.rows_fitted).cast("long").alias("rows_fitted"), F.lit(f.rows_held).cast("long").alias("rows_held"), F.lit(f.sampled).cast("array<long>").alias("sampled")) for f in listed]
    plan = drawn.select("*", F.inline(F.array(*entries)))
    return plan.withColumn("rows_sampled", F.element_at("sampled", at.cast("int"))).drop("sampled")


@query
def model_inputs(ws):
    """Inputs of the saved linear model in their order, with what its scaler subtracts and divides by, read from the saved files."""
    fitted_ols(ws)
    path = f"{ws.path('models')}/linear_regression_{len(COLUMNS)}"
    scaling = saved.scaling(ws.spark, path).select("position", "mean", "std")
    joined = saved.inputs(ws.spark, path).select("position", "feature").join(scaling, "position")
    return rounded(joined, 6, "mean", "std")


@query
def cv_document_1d(ws):
    """Scores of four model families on one input each through the nested document: typed entries, read back and listed."""
    train = ws.train_matrix()
    alpha, folds = one_input_folds(ws, [S.DISTANCE])
    params = {"depth": STUMP.depth, "n_estimators": STUMP.rounds}
    stumps = search.cross_validate(train, lambda past: boosting.fit(past, ["hour"], STUMP), "boosted_trees")
    folds = folds.unionByName(stumps.select(*folds.columns))
    path = session.scratch_path(ws.spark, "document.json")
    scores.write(scores.summary(folds), path, alpha, params)
    return scores.listed(scores.read(ws.spark, path))
