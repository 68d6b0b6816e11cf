"""The zone dimension."""

from pyspark.sql import DataFrame, SparkSession

from wayfare import schema as S


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup CSV; ``N/A`` is a missing value."""
    return (
        spark.read.schema(S.ZONE_SCHEMA)
        .option("header", True)
        .option("nullValue", "N/A")
        .csv(path)
        .select("LocationID", "Borough", "Zone", "service_zone")
    )


def write_zones(zones: DataFrame, path: str) -> None:
    zones.write.mode("overwrite").option("header", True).option("nullValue", "N/A").csv(path)
