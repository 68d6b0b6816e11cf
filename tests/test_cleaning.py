import math

import pytest
from pyspark.sql import functions as F

from conftest import moment
from wayfare import schema as S
from wayfare.functions import trip
from wayfare.operators import impute, quality
from wayfare.plans import prepare


def durations(df):
    return [r[0] for r in trip.with_duration(df).select(S.TARGET).collect()]


def test_durations_are_positive_and_exact(sample_trips):
    assert durations(sample_trips) == [25.0, 22.0, 15.0, 35.0, 45.0]


def test_zero_duration(one_trip):
    assert durations(one_trip(0)) == [0.0]


def test_negative_duration_keeps_its_sign(one_trip):
    assert durations(one_trip(-10)) == [-10.0]


def test_sub_second_duration(one_trip):
    assert durations(one_trip(0.001)) == [0.001]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_durations_ignore_the_session_time_zone(spark, one_trip, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # starts inside the hour that New York's clocks skip
        row = trip.with_duration(one_trip(45.5, **{S.PICKUP: moment("2025-03-09 02:15")})).first()
        assert (row[S.TARGET], row[S.SECONDS]) == (45.5, 2730)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def kept(df, **options):
    return prepare.prepare(df, **options).count()


def test_valid_trips_pass(sample_trips):
    assert kept(sample_trips) == 5


@pytest.mark.parametrize("minutes", [0, -5, 0.5, 0.99, 180.1, 200])
def test_bad_duration_is_removed(one_trip, minutes):
    assert kept(one_trip(minutes)) == 0


@pytest.mark.parametrize("minutes", [1, 25, 180])
def test_duration_limits_are_inclusive(one_trip, minutes):
    assert kept(one_trip(minutes)) == 1


@pytest.mark.parametrize(
    "change",
    [
        {S.PU: 999},
        {S.PU: 0},
        {S.DO: 266},
        {S.PU: None},
        {S.FARE: -5.0},
        {S.FARE: None},
        {S.FARE: math.nan},
        {S.DISTANCE: -1.0},
        {S.DISTANCE: 0.0},
        {S.DISTANCE: 0.09},
        {S.DISTANCE: 100.1},
        {S.DISTANCE: None},
        {S.DISTANCE: math.nan},
        {S.PASSENGERS: 0.0},
        {S.PASSENGERS: 9.0},
    ],
)
def test_bad_value_is_removed(one_trip, change):
    assert kept(one_trip(**change)) == 0
    assert kept(one_trip(**change), rules=quality.rules(quality.SHORT_RULES)) == 0


@pytest.mark.parametrize("passengers", [None, math.nan, 1.0, 8.0])
def test_missing_passengers_are_kept_for_imputation(one_trip, passengers):
    rows = prepare.prepare(one_trip(**{S.PASSENGERS: passengers})).collect()
    missing = passengers is None or math.isnan(passengers)
    assert len(rows) == 1 and (rows[0][S.PASSENGERS] is None) == missing


def test_duplicates(sample_trips):
    twice = sample_trips.unionAll(sample_trips)
    assert kept(twice) == 5
    assert kept(twice, dedup=False) == 10


@pytest.mark.parametrize("names,dedup", [(quality.FULL_RULES, True), (quality.SHORT_RULES, False)])
def test_audit_equals_cascaded_filters(ws, names, dedup):
    df = trip.with_duration(ws.raw().select(*S.TRIP_COLUMNS)).cache()
    audit = quality.filter_audit(df, quality.rules(names), dedup).orderBy("step").collect()
    remaining, current = df.count(), df
    for row, (name, predicate) in zip(audit, quality.rules(names)):
        current = current.filter(predicate)
        after = current.count()
        assert (row.rule, row.removed, row.remaining) == (name, remaining - after, after)
        remaining = after
    if dedup:
        assert audit[-1].rule == "duplicate_rows" and audit[-1].remaining == current.distinct().count()
    assert sum(r.removed for r in audit) + audit[-1].remaining == df.count()
    df.unpersist()


def test_audit_of_a_large_group_of_copies(spark, one_trip):
    """A third of the rows are one row, a third fail one rule, a third are distinct."""
    copies = one_trip().crossJoin(spark.range(100)).drop("id")
    bad = one_trip(**{S.FARE: -1.0}).crossJoin(spark.range(100)).drop("id")
    others = one_trip().crossJoin(spark.range(100)).withColumn(S.TOTAL, F.col("id") + 100.0).drop("id")
    audit = quality.filter_audit(trip.with_duration(copies.unionAll(bad).unionAll(others))).collect()
    removed = {r.rule: r.removed for r in audit if r.removed}
    assert removed == {"non_negative_fare": 100, "duplicate_rows": 99} and audit[-1].remaining == 101


def test_wrong_year_rule(one_trip):
    filed = one_trip().withColumns({S.SOURCE_YEAR: F.lit(2024), S.SOURCE_MONTH: F.lit(12)})
    assert quality.wrong_year(filed).count() == 1
    names = [*quality.FULL_RULES, "source_year"]
    assert prepare.prepare(filed, rules=quality.rules(names), with_source=True).count() == 0


def test_imputer_is_fitted_on_training_rows_only(spark):
    train = spark.createDataFrame(
        [(1.0, 2.0, 3.0, None), (4.0, 2.0, 1.0, "Y"), (None, 1.0, 1.0, "N"), (2.0, 1.0, None, "N")],
        f"{S.PASSENGERS} double, {S.RATE} double, {S.PAYMENT} double, {S.FLAG} string",
    )
    fitted = impute.fit_imputer(train)
    # the lower of two equally frequent rate codes wins
    assert fitted.fills == {S.PASSENGERS: 2.0, S.RATE: 1.0, S.PAYMENT: 1.0, S.FLAG: "N"}
    test = spark.createDataFrame([(None, None, None, None)] * 3, train.schema)
    assert [tuple(r) for r in fitted.apply(test).distinct().collect()] == [(2.0, 1.0, 1.0, "N")]


def test_profile_lists_only_columns_with_gaps(one_trip):
    df = one_trip(**{S.PASSENGERS: None}).unionAll(one_trip())
    rows = quality.profile(df).collect()
    assert [(r.column_name, r.missing, r.missing_pct, r.total_rows, r.total_columns) for r in rows] == [
        (S.PASSENGERS, 1, 50.0, 2, 11)
    ]


def test_schema_check_names_the_problem(one_trip):
    quality.check_schema(one_trip())
    with pytest.raises(ValueError, match=f"{S.PU}: expected int, got bigint"):
        quality.check_schema(one_trip().withColumn(S.PU, F.col(S.PU).cast("bigint")))
    with pytest.raises(ValueError, match=f"{S.FARE}.*no such column"):
        quality.check_schema(one_trip().drop(S.FARE))


def test_zero_fill(spark):
    df = spark.createDataFrame([(None,), (math.nan,), (2.0,)], "x double")
    assert sorted(r.x for r in impute.zero_fill(df, ["x"]).collect()) == [0.0, 0.0, 2.0]


def test_compact_types(one_trip):
    types = dict(prepare.compact_types(trip.with_duration(one_trip())).dtypes)
    assert types[S.PU] == "smallint" and types[S.DISTANCE] == "float" and types[S.TARGET] == "float"


def test_moment_helper():
    assert moment("2025-01-15 08:00").hour == 8


def test_audit_and_cleaner_agree_on_missing_copies(spark, one_trip):
    """Copies whose passengers are null or NaN are one trip to both."""
    copies = one_trip(**{S.PASSENGERS: None}).unionAll(one_trip(**{S.PASSENGERS: float("nan")})).unionAll(one_trip(**{S.PASSENGERS: None}))
    timed = trip.with_duration(copies)
    assert quality.clean(timed).count() == 1
    audit = {r.rule: r for r in quality.filter_audit(timed).collect()}
    assert audit["duplicate_rows"].removed == 2 and audit["duplicate_rows"].remaining == 1


def test_imputer_ignores_missing_values_and_breaks_ties(spark):
    rows = [(1.0, 3.0, None), (2.0, 3.0, None), (float("nan"), 2.0, None), (None, 2.0, None)]
    df = spark.createDataFrame(rows, f"{S.PASSENGERS} double, {S.RATE} double, {S.PAYMENT} double")
    fitted = impute.fit_imputer(df)
    assert fitted.fills == {S.PASSENGERS: 1.5, S.RATE: 2.0, S.PAYMENT: None, S.FLAG: "N"}
