"""Trip sources: monthly parquet files, partitioned trip tables, schema drift and provenance."""

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare import schema as S

FILE_PATTERN = "yellow_tripdata_{year:04d}-{month:02d}.parquet"
# Year and month in a path: of a monthly file, or of a table partitioned by source month.
MONTH_IN_FILE_NAME = r"yellow_tripdata_(\d{4})-(\d{2})\.parquet"
MONTH_IN_PARTITION = r"source_year=(\d+)/source_month=(\d+)/"

Month = tuple[int, int]


def months_between(first: Month, last: Month) -> list[Month]:
    """Every (year, month) from first to last, both included."""
    (y0, m0), (y1, m1) = first, last
    return [(i // 12, i % 12 + 1) for i in range(y0 * 12 + m0 - 1, y1 * 12 + m1)]


# The published catalogue: twelve training months, then two test months.
TRAIN_MONTHS = months_between((2025, 1), (2025, 12))
TEST_MONTHS = months_between((2026, 1), (2026, 2))


def month_paths(root: str, months: list[Month]) -> list[str]:
    return [f"{root.rstrip('/')}/{FILE_PATTERN.format(year=y, month=m)}" for y, m in months]


def source_month_columns(pattern: str = MONTH_IN_FILE_NAME) -> dict:
    """Year and month of the file a row came from, taken from its path."""
    path = F.col("_metadata.file_path")
    return {
        S.SOURCE_YEAR: F.regexp_extract(path, pattern, 1).cast("int"),
        S.SOURCE_MONTH: F.regexp_extract(path, pattern, 2).cast("int"),
    }


def conform(df: DataFrame, columns: list[str] = S.TRIP_COLUMNS, keep: list[str] = []) -> DataFrame:
    """Cast a trip table to the engine types; columns it lacks become null, kept ones stay as is."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(c) if c in present else F.lit(None)).cast(S.TRIP_SCHEMA[c].dataType).alias(c)
            for c in columns
        ],
        *keep,
    )


def union_months(frames: list[DataFrame]) -> DataFrame:
    """Concatenate trip tables whose column sets or types drifted apart."""
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [conform(f) for f in frames])


def _existing(read, path: str) -> DataFrame | None:
    try:
        return read(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_months(
    spark: SparkSession,
    root: str,
    months: list[Month],
    columns: list[str] = S.TRIP_COLUMNS,
    with_source: bool = False,
    uniform: bool = False,
) -> DataFrame:
    """Read the monthly files that exist, only the given columns, as one table in the engine types.

    Missing months drop out; no month at all is an error. Published months disagree on types, such
    as integer or floating passenger counts, so each month is read by its own footer and cast, and
    the plan is a union of pruned scans. With ``uniform`` files, all known to hold the engine types,
    the months become one glob and one scan.
    """
    if uniform:
        wanted = T.StructType([S.TRIP_SCHEMA[c] for c in columns])
        pattern = "{" + ",".join(f"{y:04d}-{m:02d}" for y, m in months) + "}"
        paths, read = [f"{root.rstrip('/')}/yellow_tripdata_{pattern}.parquet"], spark.read.schema(wanted).parquet
    else:
        paths, read = month_paths(root, months), spark.read.parquet
    found = [df for df in (_existing(read, path) for path in paths) if df is not None]
    if not found:
        raise FileNotFoundError(f"no trip files for the given months in {root}")
    if with_source:
        source = source_month_columns()
        frames = [conform(df.withColumns(source), columns, list(source)) for df in found]
    else:
        frames = [conform(df, columns) for df in found]
    return reduce(lambda a, b: a.unionByName(b), frames)


def read_trip_table(
    spark: SparkSession,
    path: str,
    months: list[Month] | None = None,
    columns: list[str] | None = None,
    year: str = S.SOURCE_YEAR,
    month: str = S.SOURCE_MONTH,
) -> DataFrame:
    """A trip table partitioned by year and month, as written by ``sinks.write_trips``.

    The month list filters partition columns: all partitions are listed, those of other months are never opened.
    """
    df = spark.read.parquet(path)
    if months is not None:
        df = df.filter((F.col(year) * 100 + F.col(month)).isin([y * 100 + m for y, m in months]))
    return df.select(*columns) if columns else df
