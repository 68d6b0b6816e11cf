"""Trips, zones and scoring requests derived from the star-schema test tables.

Those tables hold no trips, so each order line becomes one: nations stand for zones, quantities
set durations and distances, and every cleaning rule finds rows to reject.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare import schema as S

# Borough codes of the test regions; the last region is left out to exercise code 0.
REGION_CODES = {"AFRICA": 1, "AMERICA": 2, "ASIA": 3, "EUROPE": 4}
UNLISTED_NATION = 24
CUTOFF = "2000-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips with provenance. Customers and suppliers grow with the data, so no join is hinted."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    joined = (
        lines.join(orders.join(customers, F.col("o_custkey") == F.col("c_custkey")), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    part, supp, line, order = (F.col(c) for c in ("l_partkey", "l_suppkey", "l_linenumber", "l_orderkey"))
    pickup = F.timestamp_add("MINUTE", ((part * 7 + line * 131) % 1440).cast("int"), F.col("o_orderdate"))
    seconds = (F.col("l_quantity") * 240).cast("int") + (part % 600 - 300).cast("int")
    shaped = joined.select(
        pickup.alias(S.PICKUP),
        F.timestamp_add("SECOND", seconds, pickup).alias(S.DROPOFF),
        (F.col("s_nationkey") * 11).cast("int").alias(S.PU),
        (F.col("c_nationkey") * 11).cast("int").alias(S.DO),
        F.round(F.col("l_quantity") * F.col("l_discount") * 25, 2).alias(S.DISTANCE),
        (F.col("l_extendedprice") / 1000 - 1.5).alias(S.FARE),
        (F.col("l_extendedprice") / 1000).alias(S.TOTAL),
        F.when(line != 7, (part % 10).cast("double")).alias(S.PASSENGERS),
        F.when(supp % 17 != 0, (part % 4 + 1).cast("double")).alias(S.PAYMENT),
        F.when(supp % 19 != 0, (supp % 6 + 1).cast("double")).alias(S.RATE),
        F.when(line != 6, F.when(F.col("l_linestatus") == "F", "Y").otherwise("N")).alias(S.FLAG),
        # lines of every fiftieth order appear twice
        F.explode(F.when(order % 50 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy"),
    ).drop("_copy")
    # files are filed by drop-off month, so a trip over New Year sits in the wrong year's file
    return shaped.withColumns({S.SOURCE_YEAR: F.year(S.DROPOFF), S.SOURCE_MONTH: F.month(S.DROPOFF)})


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One zone per nation, but for one that stays unlisted."""
    nations = table(spark, sf_dir, "nation").filter(F.col("n_nationkey") != UNLISTED_NATION)
    regions = table(spark, sf_dir, "region")
    return nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
        (F.col("n_nationkey") * 11).cast("int").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.lit("Test Zone").alias("service_zone"),
    )


def requests(events: DataFrame) -> DataFrame:
    """Untrusted scoring requests, one per event; works on a batch or a stream.

    Some timestamps and distances are unreadable, some optional fields are absent.
    """
    event = F.col("event_id")
    return events.select(
        "event_id",
        F.col("user_id").cast("int").alias("pickup_location_id"),
        (event % 270).cast("int").alias("dropoff_location_id"),
        F.when(event % 101 == 0, "far").otherwise((F.col("value") / 10).cast("string")).alias("trip_distance"),
        F.when(event % 97 == 0, "soon").otherwise(F.substring(F.col("ts").cast("string"), 1, 19)).alias("pickup_datetime"),
        F.when(event % 5 != 0, (event % 11).cast("int")).alias("passenger_count"),
        F.when(event % 7 != 0, (event % 6 + 1).cast("int")).alias("rate_code_id"),
        F.when(event % 3 != 0, (event % 6 + 1).cast("int")).alias("payment_type"),
        F.when(event % 4 != 0, F.round(F.col("value") - 1, 2)).alias("fare_amount"),
    )
