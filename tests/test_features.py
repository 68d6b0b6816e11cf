import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wayfare import schema as S
from wayfare.functions import time as calendar
from wayfare.functions import trip
from wayfare.operators import lookup, profiling
from wayfare.plans import features


@pytest.fixture(scope="module")
def timed(sample_trips):
    return calendar.with_cyclic_features(calendar.with_time_features(sample_trips)).orderBy(S.PICKUP).collect()


def at(spark, text):
    df = spark.createDataFrame([(datetime.fromisoformat(text),)], f"{S.PICKUP} timestamp_ntz")
    return calendar.with_time_features(df).first()


def test_hour(timed):
    assert [r.hour for r in timed] == [8, 14, 0, 12, 17]


def test_days_count_from_monday(timed):
    assert timed[0].day_of_week == 2  # a Wednesday
    assert timed[2].day_of_week == 6  # a Sunday


def test_weekend(spark):
    assert at(spark, "2025-01-18 12:00").is_weekend == 1
    assert at(spark, "2025-01-17 12:00").is_weekend == 0


@pytest.mark.parametrize("hour,rush", [(6, 0), (7, 1), (8, 1), (9, 1), (10, 0), (11, 0), (15, 0), (16, 1), (17, 1), (19, 1), (20, 0), (22, 0)])
def test_rush_hour(spark, hour, rush):
    assert at(spark, f"2025-01-15 {hour:02d}:30").is_rush_hour == rush


@pytest.mark.parametrize("hour,night", [(21, 0), (22, 1), (0, 1), (5, 1), (6, 0)])
def test_night(spark, hour, night):
    assert at(spark, f"2025-01-15 {hour:02d}:59").is_night == night


def test_month_quarter_and_iso_week(timed):
    assert [r.month for r in timed] == [1, 3, 6, 7, 12]
    assert [r.quarter for r in timed] == [1, 1, 2, 3, 4]
    assert timed[4].week_of_year == 1  # 2025-12-31 lies in the first ISO week of 2026
    assert timed[4].day_of_month == 31 and timed[4].year == 2025


def test_cyclic_values_stay_on_the_circle(timed):
    for r in timed:
        for name in calendar.CYCLES:
            sine, cosine = r[f"{name}_sin"], r[f"{name}_cos"]
            assert -1 <= sine <= 1 and -1 <= cosine <= 1
            assert sine**2 + cosine**2 == pytest.approx(1)


def test_last_hour_is_near_the_first(spark):
    hours = spark.createDataFrame([(0,), (12,), (23,)], "hour int")
    sine, cosine = calendar.cyclic(F.col("hour"), 24)
    at = {r.hour: (r.s, r.c) for r in hours.select("hour", sine.alias("s"), cosine.alias("c")).collect()}
    assert math.dist(at[0], at[23]) < math.dist(at[0], at[12])


def test_labels(spark):
    r = spark.range(1).select(
        calendar.day_label(F.lit(0)), calendar.month_label(F.lit(12)), trip.rate_label(F.lit(2.0)), trip.rate_label(F.lit(99.0))
    ).first()
    assert tuple(r) == ("Mon", "Dec", "JFK", "99")


def test_log_distance(spark, sample_trips):
    assert all(r[0] > 0 for r in sample_trips.select(trip.log_distance(F.col(S.DISTANCE))).collect())
    assert spark.range(1).select(trip.log_distance(F.lit(0.0))).first()[0] == 0.0


def test_baseline_duration(sample_trips):
    rows = trip.with_distance_features(sample_trips, 12.5).orderBy(S.PICKUP).collect()
    assert rows[0].baseline_duration == pytest.approx(12.0)


def test_same_zone_flag(sample_trips, one_trip):
    flag = trip.same_zone(F.col(S.PU), F.col(S.DO))
    assert {r[0] for r in sample_trips.select(flag).collect()} == {0}
    assert one_trip(**{S.DO: 132}).select(flag).first()[0] == 1


def test_interactions(sample_trips):
    r = trip.with_interactions(calendar.with_time_features(sample_trips)).orderBy(S.PICKUP).first()
    assert (r.distance_x_rush, r.distance_x_weekend, r.distance_x_hour) == (2.5, 0.0, 20.0)


def test_unknown_route_falls_back_to_the_global_mean(spark, one_trip):
    routes = spark.createDataFrame(
        [(132, 236, 20.0, 19.0), (161, 170, 18.5, 18.0)],
        f"{S.PU} int, {S.DO} int, route_mean_duration double, route_median_duration double",
    )
    both = one_trip().unionAll(one_trip(**{S.PU: 99, S.DO: 88}))
    rows = features.with_route_features(both, routes, 15.0).orderBy(F.col(S.PU).desc()).collect()
    assert [(r.route_mean_duration, r.route_median_duration) for r in rows] == [(20.0, 19.0), (15.0, 15.0)]
    coverage = features.route_coverage(both, routes).first()
    assert (coverage.trips, coverage.matched, coverage.coverage_pct) == (2, 1, 50.0)


def test_location_features(spark, one_trip):
    profile = spark.createDataFrame(
        [(132, 4, 10, 7), (236, 1, 3, 9)], "LocationID int, borough int, pickups bigint, dropoffs bigint"
    )
    df = one_trip().unionAll(one_trip(**{S.DO: 5}))
    rows = {r[S.DO]: r for r in features.with_location_features(df, profile).collect()}
    known, unseen = rows[236], rows[5]
    assert (known.pu_borough, known.do_borough, known.cross_borough_flag) == (4, 1, 1)
    assert (known.pu_zone_rank, known.do_zone_rank) == (10, 9)
    assert (unseen.do_borough, unseen.do_zone_rank) == (0, 0)


def test_zone_profile_without_zone_table_and_with_repeated_ids(spark):
    counts = spark.createDataFrame([(1, 5, 6)], "LocationID int, pickups bigint, dropoffs bigint")
    assert features.zone_profile(counts, None).first().borough == 0
    zones = spark.createDataFrame([(1, "EWR"), (1, "EWR"), (2, None)], "LocationID int, Borough string")
    rows = sorted(tuple(r) for r in features.zone_profile(counts, zones).collect())
    assert rows == [(1, 6, 5, 6), (2, 0, 0, 0)]


def test_borough_codes(spark):
    names = spark.createDataFrame([("Manhattan",), ("EWR",), ("Atlantis",), (None,)], "b string")
    assert [r[0] for r in names.select(trip.borough_code(F.col("b"))).collect()] == [1, 6, 0, 0]


def test_feature_lists():
    assert len(features.feature_set("full")) == 32 and len(features.feature_set("short")) == 29
    assert S.FARE not in features.feature_set("full", with_fare=False)


def test_artifacts_do_not_see_test_rows(spark, ws, tmp_path):
    train = ws.train()
    doubled = train.unionByName(ws.test().withColumn(S.SECONDS, F.lit(60).cast("bigint")))
    alone = features.fit(train, str(tmp_path / "a"), min_route_count=5)
    kept = features.fit(doubled.filter(F.col(S.PICKUP) < "2000-01-01"), str(tmp_path / "b"), min_route_count=5)
    assert alone.global_mean == kept.global_mean and alone.avg_speed_mph == pytest.approx(kept.avg_speed_mph)
    assert alone.routes.exceptAll(kept.routes).isEmpty()


def test_artifacts_survive_saving(spark, tmp_path, ws):
    fitted = features.fit(ws.train(), str(tmp_path / "v1"), ws.zones(), min_route_count=5)
    again = features.Artifacts.load(spark, str(tmp_path / "v1"))
    assert again.global_mean == fitted.global_mean
    assert again.routes.exceptAll(fitted.routes).isEmpty() and again.zone_profile.count() > 0


def test_speed_falls_back_without_plausible_trips(spark, ws, tmp_path):
    fast = ws.train().withColumn(S.DISTANCE, F.lit(1e6))
    assert features.fit(fast, str(tmp_path / "v1")).avg_speed_mph == S.DEFAULT_SPEED_MPH


def test_lookup_key_must_stay_inside_the_zone_domain(spark):
    df = spark.range(5).select(F.col("id").cast("int").alias("a"))
    assert lookup.zone_keyed(df, "a").count() == 4
    with pytest.raises(ValueError):
        lookup.zone_keyed(df, "a", "a", "a")


def test_route_stats_against_pandas(ws):
    pdf = ws.train().select(S.PU, S.DO, S.TARGET).toPandas()
    want = pdf.groupby([S.PU, S.DO])[S.TARGET].agg(["mean", "median", "std", "count"])
    got = features.route_stats(features.route_seconds(ws.train()), 1).toPandas().set_index([S.PU, S.DO]).loc[want.index]
    assert (got.trips == want["count"]).all()
    for ours, theirs in [("route_mean_duration", "mean"), ("route_median_duration", "median"), ("route_std_duration", "std")]:
        assert got[ours].sub(want[theirs]).abs().fillna(0).max() < 1e-9
        assert (got[ours].isna() == want[theirs].isna()).all()


@pytest.mark.parametrize(
    "distance,label",
    [(0.0, None), (-1.0, None), (0.5, "<1mi"), (1.0, "<1mi"), (1.01, "1-2mi"), (20.0, "10-20mi"), (100.0, ">20mi"), (100.1, None)],
)
def test_distance_bands_close_on_the_right(spark, distance, label):
    assert spark.range(1).select(trip.distance_band(F.lit(distance))).first()[0] == label


def test_mean_by_hour_matches_pandas(ws):
    timed = calendar.with_time_features(ws.train())
    got = profiling.mean_duration_by(timed, "hour").toPandas().set_index("hour").mean_minutes.sort_index()
    want = timed.select("hour", S.TARGET).toPandas().groupby("hour")[S.TARGET].mean()
    assert got.sub(want).abs().max() < 1e-6
