"""Sinks: partitioned parquet trips, feature matrices, CSV exports, JSON scores."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare import schema as S


def write_trips(
    df: DataFrame, path: str, year: str, month: str, mode: str = "overwrite", derive: Callable[[DataFrame], DataFrame] | None = None
) -> None:
    """Snappy parquet partitioned by year and month.

    The rebalance hint groups each month's rows for few, large files, and lets adaptive execution
    split a month that holds a large share of all rows across several writers. ``derive`` adds columns
    that follow from the others; it runs after the shuffle, which then does not carry them.
    """
    grouped = df.hint("rebalance", year, month)
    (
        (derive(grouped) if derive else grouped)
        .write.mode(mode)
        .option("compression", "snappy")
        .partitionBy(year, month)
        .parquet(path)
    )


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: tuple[str, ...] = ()) -> None:
    """Snappy parquet. Partitioning adds no shuffle: use it where each task holds few keys."""
    df.write.mode(mode).option("compression", "snappy").partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def with_pickup_month(df: DataFrame) -> DataFrame:
    """Partition columns of a cleaned trip table."""
    return df.withColumns({"year": F.year(S.PICKUP), "month": F.month(S.PICKUP)})
