"""The trip data model: column names, Spark types and the fixed business limits."""

from pyspark.sql import types as T

PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"
PU = "PULocationID"
DO = "DOLocationID"
DISTANCE = "trip_distance"
FARE = "fare_amount"
TOTAL = "total_amount"
PASSENGERS = "passenger_count"
RATE = "RatecodeID"
PAYMENT = "payment_type"
FLAG = "store_and_fwd_flag"

TARGET = "trip_duration_minutes"
SECONDS = "duration_s"
SOURCE_YEAR = "source_year"
SOURCE_MONTH = "source_month"

# Timestamps carry no zone, so they stay TIMESTAMP_NTZ from scan to sink.
TRIP_SCHEMA = T.StructType(
    [
        T.StructField(PICKUP, T.TimestampNTZType()),
        T.StructField(DROPOFF, T.TimestampNTZType()),
        T.StructField(PU, T.IntegerType()),
        T.StructField(DO, T.IntegerType()),
        T.StructField(DISTANCE, T.DoubleType()),
        T.StructField(FARE, T.DoubleType()),
        T.StructField(TOTAL, T.DoubleType()),
        T.StructField(PASSENGERS, T.DoubleType()),
        T.StructField(PAYMENT, T.DoubleType()),
        T.StructField(RATE, T.DoubleType()),
        T.StructField(FLAG, T.StringType()),
    ]
)
TRIP_COLUMNS = TRIP_SCHEMA.fieldNames()

ZONE_SCHEMA = T.StructType(
    [
        T.StructField("LocationID", T.IntegerType()),
        T.StructField("Borough", T.StringType()),
        T.StructField("Zone", T.StringType()),
        T.StructField("service_zone", T.StringType()),
    ]
)

# Fixed limits of the cleaning rules (inclusive).
MIN_MINUTES, MAX_MINUTES = 1, 180
MIN_MILES, MAX_MILES = 0.1, 100
MIN_ZONE, MAX_ZONE = 1, 265
MIN_PASSENGERS, MAX_PASSENGERS = 1, 8
MAX_SPEED_MPH = 80

# Fixed defaults.
DEFAULT_SPEED_MPH = 12.5
MIN_ROUTE_COUNT = 50

# Cleaned zone ids are integers in [MIN_ZONE, MAX_ZONE], whatever the data volume. This is the
# proof behind every broadcast of a zone or route lookup.
ZONE_DOMAIN = MAX_ZONE - MIN_ZONE + 1
