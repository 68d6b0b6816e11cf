from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wayfare import schema as S
from wayfare.functions import requests as R
from wayfare.functions import trip
from wayfare.models import pipelines
from wayfare.plans import catalog, features, scoring
from wayfare.sources import star_schema
from wayfare.streaming import scoring as streaming

FIELDS = (
    "pickup_location_id int, dropoff_location_id int, trip_distance string, pickup_datetime string, "
    "passenger_count int, rate_code_id int, payment_type int, fare_amount double"
)
GOOD = dict(
    pickup_location_id=132,
    dropoff_location_id=236,
    trip_distance="2.5",
    pickup_datetime="2025-06-15 08:30:00",
    passenger_count=None,
    rate_code_id=None,
    payment_type=None,
    fare_amount=None,
)


def request(spark, **changes):
    return spark.createDataFrame([tuple({**GOOD, **changes}.values())], FIELDS)


def test_defaults(spark):
    r = R.validate(request(spark)).first()
    assert r.reject_reason is None
    assert (r.passenger_count, r.rate_code_id, r.payment_type, r.fare_amount) == (1, 1, 1, 10.0)


def test_fare_estimate(spark):
    assert R.validate(request(spark), estimate_fare=True).first().fare_amount == 8.75
    assert R.validate(request(spark, fare_amount=3.0), estimate_fare=True).first().fare_amount == 3.0


@pytest.mark.parametrize(
    "change,reason",
    [
        ({"pickup_location_id": 0}, "pickup_location_id"),
        ({"pickup_location_id": None}, "pickup_location_id"),
        ({"dropoff_location_id": 266}, "dropoff_location_id"),
        ({"trip_distance": "0"}, "trip_distance"),
        ({"trip_distance": "far"}, "trip_distance"),
        ({"trip_distance": "NaN"}, "trip_distance"),
        ({"trip_distance": None}, "trip_distance"),
        ({"pickup_datetime": "soon"}, "pickup_datetime"),
        ({"passenger_count": 9}, "passenger_count"),
        ({"rate_code_id": 7}, "rate_code_id"),
        ({"payment_type": 0}, "payment_type"),
        ({"fare_amount": -0.01}, "fare_amount"),
    ],
)
def test_rejects(spark, change, reason):
    assert R.validate(request(spark, **change)).first().reject_reason == reason


def predicted(spark, value):
    scored = spark.createDataFrame([(value, 12.0, "2025-06-15 08:30:00")], "p double, baseline_duration_minutes double, pickup_datetime string")
    return scoring.arrivals(scored.withColumnRenamed("p", "predicted_duration_minutes")).first()


def test_arrival(spark):
    r = predicted(spark, 45.5)
    assert (r.arrival, r.delta_minutes, r.band, r.traffic, r.day_kind) == ("09:15", 33.5, "long", "rush", "weekend")


@pytest.mark.parametrize("minutes,band", [(0.0, "short"), (19.99, "short"), (20.0, "medium"), (45.0, "long"), (120.0, "long"), (121.0, None)])
def test_bands(spark, minutes, band):
    assert predicted(spark, minutes).band == band


def test_served_range(spark):
    df = spark.createDataFrame([(-3.0,), (50.0,), (999.0,), (None,)], "p double")
    assert [r[0] for r in df.select(trip.clip(F.col("p"), *scoring.SERVED_RANGE)).collect()] == [1.0, 50.0, 300.0, None]


def test_serving_features_equal_training_features(spark, ws):
    """A request and a trip with the same values get the same inputs."""
    trips = ws.test().withColumn("row", F.monotonically_increasing_id()).filter(F.col(S.RATE) <= 6).limit(200).cache()
    asked = trips.select(
        "row",
        F.col(S.PU).alias("pickup_location_id"),
        F.col(S.DO).alias("dropoff_location_id"),
        F.col(S.DISTANCE).cast("string").alias("trip_distance"),
        F.substring(F.col(S.PICKUP).cast("string"), 1, 19).alias("pickup_datetime"),
        *[F.col(a).cast("int").alias(b) for a, b in [(S.PASSENGERS, "passenger_count"), (S.RATE, "rate_code_id"), (S.PAYMENT, "payment_type")]],
        S.FARE,
    )
    columns = features.feature_set("full")
    trained = features.matrix(ws.featured(trips), columns, ["row"])
    served = features.matrix(features.apply(R.as_trips(R.validate(asked)), ws.artifacts), columns, ["row"])
    assert trained.count() == served.count() == trips.count()
    assert trained.exceptAll(served).isEmpty()


@pytest.fixture(scope="module")
def predictor(ws):
    columns = features.feature_set("full")
    return scoring.model_predictor(pipelines.linear_regression(columns).fit(ws.train_matrix()), columns)


def test_stream_equals_batch(spark, ws, predictor):
    batch = scoring.score(catalog.valid_requests(ws), ws.artifacts, predictor, "m", ["event_id"])
    stream = catalog.run_stream(ws, predictor, "m").filter(F.col("reject_reason").isNull()).select(*batch.columns)
    assert batch.exceptAll(stream).isEmpty() and stream.exceptAll(batch).isEmpty()


def test_restarted_stream_scores_new_files_once(spark, ws, tmp_path):
    events = star_schema.table(spark, ws.sf_dir, "events")
    inbox = str(tmp_path / "in")
    chain = scoring.column_predictor("route_mean_duration")

    def run():
        stream = star_schema.requests(streaming.read_stream(spark, inbox, events.schema, max_files=1))
        paths = [str(tmp_path / p) for p in ("out", "bad", "ckpt")]
        streaming.run_to_end(streaming.score_stream(stream, ws.artifacts, chain, "m", *paths, keep=["event_id"]))
        return spark.read.parquet(paths[0]).count() + spark.read.parquet(paths[1]).count()

    events.filter("event_id < 40").coalesce(1).write.mode("append").parquet(inbox)
    events.filter("event_id between 40 and 99").coalesce(1).write.mode("append").parquet(inbox)
    assert run() == 100
    assert run() == 100
    events.filter("event_id between 100 and 149").coalesce(1).write.mode("append").parquet(inbox)
    assert run() == 150


def test_parsed_times(spark):
    df = spark.createDataFrame([("2025-06-15 08:30:00",), ("2025-06-15T08:30:00",), ("x",), (None,)], "t string")
    got = [r[0] for r in df.select(trip.parse_timestamp(F.col("t"))).collect()]
    assert got == [datetime(2025, 6, 15, 8, 30)] * 2 + [None, None]
