"""Time-ordered splits: train/test by cut-off, and expanding-window validation blocks."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare import schema as S
from wayfare.functions.time import moment
from wayfare.operators.selection import SortKey, at_or_after, count_and_range, row_cuts


def by_cutoff(df: DataFrame, cutoff: str) -> tuple[DataFrame, DataFrame]:
    """Trips picked up before the cut-off, and from it on.

    On a table partitioned by pickup year and month, the matching predicate on the partition
    columns prunes whole months on either side.
    """
    edge = moment(cutoff)
    before, after = F.col(S.PICKUP) < edge, F.col(S.PICKUP) >= edge
    if {"year", "month"} <= set(df.columns):
        month, edge_month = (F.col("year") * 12 + F.col("month"), F.year(edge) * 12 + F.month(edge))
        before, after = before & (month <= edge_month), after & (month >= edge_month)
    return df.filter(before), df.filter(after)


def trip_order(columns: list[str] | None = None) -> list[SortKey]:
    """Pickup time, then every other trip column there is, as a total order on distinct cleaned trips.

    Both times, zones and the distance are never null in a cleaned trip; other columns may be, and nulls come first.
    """
    present = set(S.TRIP_COLUMNS if columns is None else columns)
    order = [SortKey.timestamp(S.PICKUP), SortKey.timestamp(S.DROPOFF), *[SortKey.of(F.col(c)) for c in (S.PU, S.DO, S.DISTANCE)]]
    for c in (S.FARE, S.TOTAL, S.PASSENGERS, S.RATE, S.PAYMENT):
        if c in present:
            order += SortKey.nullable(F.col(c), 0)
    if S.FLAG in present:
        order += SortKey.nullable((F.col(S.FLAG) == "Y").cast("int"), 0)
    return order


def fold_ranks(n: int, k: int) -> list[int]:
    """First row of each of the k validation folds among n time-ordered rows."""
    size = n // (k + 1)
    if size == 0:
        raise ValueError(f"{n} rows cannot make {k} folds")
    return [n - (k - i) * size for i in range(k)]


def with_time_blocks(df: DataFrame, k: int = 5, order: list[SortKey] | None = None) -> DataFrame:
    """Add ``block`` 0..k: fold i trains on blocks <= i and validates on block i + 1.

    Only the k cut rows are looked up; the block itself is then a comparison with k literals. No
    row numbers, no global sort, no shuffle, and a moment shared by many trips is split exactly.
    """
    order = order or trip_order(df.columns)
    bounds = count_and_range(df, order[0].number)
    cuts = row_cuts(df, order, fold_ranks(bounds[0], k), bounds)
    block = sum((at_or_after(order, cut).cast("int") for cut in cuts), F.lit(0))
    return df.withColumn("block", block)
