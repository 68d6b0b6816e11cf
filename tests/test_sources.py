from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import executed_plan
from wayfare import schema as S
from wayfare import session
from wayfare.functions import trip
from wayfare.plans import features
from wayfare.sources import sinks, trips, zones


@pytest.fixture(scope="module")
def monthly(sample_trips, tmp_path_factory):
    """Single-file months as published: microsecond times, and integer codes in some months only."""
    root = tmp_path_factory.mktemp("raw")
    rows = sample_trips.toPandas()
    for year, month in [(2025, 1), (2025, 3), (2025, 12)]:
        stamp = rows[S.PICKUP].dt
        part = rows[(stamp.year == year) & (stamp.month == month)].assign(unused="x")
        table = pa.Table.from_pandas(part, preserve_index=False)
        kinds = {S.PICKUP: pa.timestamp("us"), S.DROPOFF: pa.timestamp("us")}
        if month == 1:
            kinds.update({S.PASSENGERS: pa.int64(), S.RATE: pa.int64(), S.PU: pa.int64()})
        table = table.cast(pa.schema([pa.field(f.name, kinds.get(f.name, f.type)) for f in table.schema]))
        pq.write_table(table, trips.month_paths(str(root), [(year, month)])[0])
    return str(root)


def test_month_catalogue():
    assert len(trips.TRAIN_MONTHS) == 12 and trips.TEST_MONTHS == [(2026, 1), (2026, 2)]
    assert trips.months_between((2025, 11), (2026, 2)) == [(2025, 11), (2025, 12), (2026, 1), (2026, 2)]


def test_missing_months_are_skipped(spark, monthly):
    df = trips.read_months(spark, monthly, trips.TRAIN_MONTHS)
    assert df.schema == S.TRIP_SCHEMA and df.count() == 3
    assert sorted(r[S.PASSENGERS] for r in df.collect()) == [1.0, 2.0, 3.0]


def test_uniform_months_are_one_scan(spark, monthly):
    df = trips.read_months(spark, monthly, [(2025, 2), (2025, 3), (2025, 12)], uniform=True, with_source=True)
    assert df.count() == 2 and "Union" not in executed_plan(df)
    with pytest.raises(FileNotFoundError):
        trips.read_months(spark, monthly, trips.TEST_MONTHS, uniform=True)


def test_no_month_at_all_is_an_error(spark, monthly):
    with pytest.raises(FileNotFoundError):
        trips.read_months(spark, monthly, trips.TEST_MONTHS)


def test_only_wanted_columns_are_read(spark, monthly):
    df = trips.read_months(spark, monthly, trips.TRAIN_MONTHS, [S.DISTANCE]).filter(F.col(S.DISTANCE) > 1)
    plan = executed_plan(df)
    assert "GreaterThan(trip_distance,1.0)" in plan and S.FARE not in plan


def test_provenance_from_file_names(spark, monthly):
    df = trips.read_months(spark, monthly, trips.TRAIN_MONTHS, with_source=True)
    got = {(r[S.SOURCE_YEAR], r[S.SOURCE_MONTH], r[S.PICKUP].month) for r in df.collect()}
    assert got == {(2025, 1, 1), (2025, 3, 3), (2025, 12, 12)}


def test_union_of_drifted_months(spark, sample_trips):
    drifted = sample_trips.drop(S.TOTAL).withColumn(S.PASSENGERS, F.col(S.PASSENGERS).cast("int")).select(
        S.FARE, *[c for c in S.TRIP_COLUMNS if c not in (S.TOTAL, S.FARE)]
    )
    both = trips.union_months([sample_trips, drifted])
    assert both.schema == sample_trips.schema
    assert both.count() == 10 and both.filter(F.col(S.TOTAL).isNull()).count() == 5
    with pytest.raises(ValueError):
        trips.union_months([])


def test_partitioned_sink_prunes_months(spark, sample_trips, tmp_path):
    path = str(tmp_path / "trips")
    sinks.write_trips(sinks.with_pickup_month(sample_trips), path, "year", "month")
    one = trips.read_trip_table(spark, path, [(2025, 6)], S.TRIP_COLUMNS, "year", "month")
    assert one.count() == 1 and one.schema == sample_trips.schema
    assert "PartitionFilters: [" in executed_plan(one) and "PartitionFilters: []" not in executed_plan(one)
    assert trips.read_trip_table(spark, path).select(*S.TRIP_COLUMNS).exceptAll(sample_trips).isEmpty()


def test_partitioned_sink_derives_columns_after_its_shuffle(spark, sample_trips, tmp_path):
    path, widths = str(tmp_path / "trips"), []

    def derive(moved):
        widths.append(moved.columns)
        return trip.with_duration(moved)

    sinks.write_trips(sinks.with_pickup_month(sample_trips), path, "year", "month", derive=derive)
    back = spark.read.parquet(path).select(*S.TRIP_COLUMNS, S.TARGET, S.SECONDS)
    assert widths == [[*S.TRIP_COLUMNS, "year", "month"]]
    assert back.exceptAll(trip.with_duration(sample_trips)).isEmpty() and back.count() == sample_trips.count()


def test_zone_csv_reads_na_as_missing(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text(
        '"LocationID","Borough","Zone","service_zone"\n1,"EWR","Newark Airport","EWR"\n264,"Unknown","N/A","N/A"\n265,"N/A","Outside of NYC","N/A"\n'
    )
    rows = zones.read_zones(spark, str(path)).orderBy("LocationID").collect()
    assert [tuple(r) for r in rows] == [
        (1, "EWR", "Newark Airport", "EWR"),
        (264, "Unknown", None, None),
        (265, None, "Outside of NYC", None),
    ]


def test_timestamps_stay_free_of_zones(spark, monthly):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 02:30 does not exist in New York on this day
        df = spark.createDataFrame([(datetime(2025, 3, 9, 2, 30),)], "t timestamp_ntz")
        assert df.select(F.hour("t")).first()[0] == 2
        assert trips.read_months(spark, monthly, [(2025, 1)]).first()[S.PICKUP] == datetime(2025, 1, 15, 8)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_scratch_paths_never_repeat(spark):
    a, b = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert a != b and a.startswith(session.scratch_root(spark))


def test_literal_rows(spark):
    df = session.literal_rows(spark, [(1, "a"), (2, None)], "n bigint, s string")
    assert [tuple(r) for r in df.collect()] == [(1, "a"), (2, None)] and df.schema["n"].dataType.typeName() == "long"


def test_matrix_fills_gaps_with_zero(spark):
    df = spark.createDataFrame([(None, 1, 2.0), (float("nan"), None, 3.0)], f"a double, b int, {S.TARGET} double")
    assert [tuple(r) for r in features.matrix(df, ["a", "b"]).collect()] == [(0.0, 1.0, 2.0), (0.0, 0.0, 3.0)]
