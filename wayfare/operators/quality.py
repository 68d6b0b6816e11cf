"""Quality rules, the one-pass filter audit, duplicates, and table validation."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare import schema as S

Rule = tuple[str, Column]


def not_nan(column: str) -> Column:
    """Spark orders NaN above every number, so a lone ``>=`` would let it through."""
    return ~F.isnan(column)


def _rule_columns() -> dict[str, Column]:
    minutes, distance = F.col(S.TARGET), F.col(S.DISTANCE)
    passengers = F.col(S.PASSENGERS)
    return {
        "positive_duration": minutes > 0,
        "duration_range": minutes.between(S.MIN_MINUTES, S.MAX_MINUTES),
        "positive_distance": (distance > 0) & not_nan(S.DISTANCE),
        "distance_range": distance.between(S.MIN_MILES, S.MAX_MILES),
        "valid_zones": F.col(S.PU).between(S.MIN_ZONE, S.MAX_ZONE) & F.col(S.DO).between(S.MIN_ZONE, S.MAX_ZONE),
        "valid_pickup_zone": F.col(S.PU).between(S.MIN_ZONE, S.MAX_ZONE),
        "valid_dropoff_zone": F.col(S.DO).between(S.MIN_ZONE, S.MAX_ZONE),
        "passenger_count": passengers.isNull()
        | F.isnan(passengers)
        | passengers.between(S.MIN_PASSENGERS, S.MAX_PASSENGERS),
        "non_negative_fare": (F.col(S.FARE) >= 0) & not_nan(S.FARE),
        "source_year": F.year(S.PICKUP) == F.col(S.SOURCE_YEAR),
    }


# Rule orders of the two pipeline variants; the order decides which rule an audit blames.
FULL_RULES = [
    "positive_duration",
    "duration_range",
    "positive_distance",
    "distance_range",
    "valid_zones",
    "passenger_count",
    "non_negative_fare",
]
SHORT_RULES = [
    "duration_range",
    "distance_range",
    "valid_pickup_zone",
    "valid_dropoff_zone",
    "non_negative_fare",
    "passenger_count",
]


def rules(names: list[str] = FULL_RULES) -> list[Rule]:
    columns = _rule_columns()
    return [(name, columns[name]) for name in names]


def apply_rules(df: DataFrame, quality_rules: list[Rule]) -> DataFrame:
    """Rows that pass every rule, in one filter. A rule that is null for a row rejects it."""
    return df.filter(reduce(lambda a, b: a & b, [predicate for _, predicate in quality_rules]))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Treat NaN as missing. Use after filtering, so the filters still reach the scan."""
    doubles = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in doubles})


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """One of each set of identical rows. Copies collapse map-side, before the shuffle."""
    return df.distinct()


def clean(df: DataFrame, quality_rules: list[Rule] | None = None, dedup: bool = True) -> DataFrame:
    kept = nan_to_null(apply_rules(df, quality_rules or rules()))
    return drop_duplicate_rows(kept) if dedup else kept


def first_failed_rule(quality_rules: list[Rule]) -> Column:
    """Name of the first rule a row fails; null for a row that passes all."""
    result = F.lit(None).cast("string")
    for name, predicate in reversed(quality_rules):
        result = F.when(F.coalesce(predicate, F.lit(False)), result).otherwise(F.lit(name))
    return result


def filter_audit(df: DataFrame, quality_rules: list[Rule] | None = None, dedup: bool = True) -> DataFrame:
    """Rows removed by each rule in order, with percentages of the input and rows remaining.

    One pass and one shuffle stand in for a chain of filters: each row is blamed on the first rule
    it fails. Failing rows collapse to one row per rule before the shuffle; only passing rows
    carry their columns, to find the duplicates among them.
    """
    quality_rules = quality_rules or rules()
    data_columns = df.columns
    # NaN is missing here as in ``clean``, so both find the same copies
    blamed = nan_to_null(df.withColumn("_failed", first_failed_rule(quality_rules)))
    if dedup:
        keys = ["_failed"] + [F.when(F.col("_failed").isNull(), F.col(c)).alias(c) for c in data_columns]
        blamed = blamed.select(*keys).groupBy("_failed", *data_columns).agg(F.count(F.lit(1)).alias("_n"))
    else:
        blamed = blamed.select("_failed", F.lit(1).cast("bigint").alias("_n"))
    names = [name for name, _ in quality_rules]
    sums = [F.sum(F.when(F.col("_failed") == name, F.col("_n"))) for name in names]
    if dedup:
        names = names + ["duplicate_rows"]
        sums.append(F.sum(F.when(F.col("_failed").isNull(), F.col("_n") - 1)))
    wide = blamed.agg(
        F.sum("_n").alias("initial_rows"),
        *[F.coalesce(s, F.lit(0).cast("bigint")).alias(f"_r{i}") for i, s in enumerate(sums)],
    )
    entries = []
    for i, name in enumerate(names):
        removed_so_far = reduce(lambda a, b: a + b, [F.col(f"_r{j}") for j in range(i + 1)])
        entries.append(
            F.struct(
                F.lit(i + 1).alias("step"),
                F.lit(name).alias("rule"),
                F.col(f"_r{i}").alias("removed"),
                F.round(F.try_divide(F.col(f"_r{i}") * 100.0, F.col("initial_rows")), 3).alias("removed_pct"),
                (F.col("initial_rows") - removed_so_far).alias("remaining"),
            )
        )
    return wide.select(F.inline(F.array(*entries)))


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Missing values (null or NaN) per column, from a single aggregate over the table."""
    types = dict(df.dtypes)
    columns = columns or df.columns

    def missing(c):
        return F.col(c).isNull() | F.isnan(c) if types[c] in ("double", "float") else F.col(c).isNull()

    wide = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(missing(c)).alias(f"_m{i}") for i, c in enumerate(columns)]
    )
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"_m{i}").alias("missing"),
            F.round(F.try_divide(F.col(f"_m{i}") * 100.0, F.col("_rows")), 2).alias("missing_pct"),
            F.col("_rows").alias("total_rows"),
        )
        for i, c in enumerate(columns)
    ]
    return wide.select(F.inline(F.array(*entries)))


def profile(df: DataFrame) -> DataFrame:
    """Validation report: the columns that have missing values, with table row and column counts."""
    return null_counts(df).filter("missing > 0").withColumn("total_columns", F.lit(len(df.columns)))


def wrong_year(df: DataFrame) -> DataFrame:
    """Rows whose pickup year differs from the year of the file they came from."""
    return df.filter(F.year(S.PICKUP) != F.col(S.SOURCE_YEAR))


def check_schema(df: DataFrame, columns: list[str] = S.TRIP_COLUMNS) -> DataFrame:
    """Fail early, by name and type, when a trip table does not fit the data model."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    wrong = [
        f"{c}: expected {S.TRIP_SCHEMA[c].dataType.simpleString()}, got "
        + (actual[c].simpleString() if c in actual else "no such column")
        for c in columns
        if actual.get(c) != S.TRIP_SCHEMA[c].dataType
    ]
    if wrong:
        raise ValueError("trip table does not fit the schema: " + "; ".join(wrong))
    return df
