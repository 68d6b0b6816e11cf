"""Missing-value imputation, fitted on training rows and applied anywhere."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare import schema as S
from wayfare.operators.selection import quantiles_of

DEFAULT_FLAG = "N"


@dataclass(frozen=True)
class Imputer:
    fills: dict[str, object]

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in self.fills.items() if v is not None})


def fit_imputer(
    train: DataFrame,
    medians: tuple[str, ...] = (S.PASSENGERS,),
    modes: tuple[str, ...] = (S.RATE, S.PAYMENT),
    constants: dict[str, object] | None = None,
) -> Imputer:
    """Median, mode (smallest value on ties) and constant fills.

    Modes come from one row per column and value, pre-aggregated map-side, and the greatest count of those; medians from
    rank selection. No task ever holds a map of all values, however many a raw code column has.
    """
    fitted: dict[str, object] = {name: q[0] for name, q in quantiles_of(train, {c: F.col(c) for c in medians}, [0.5]).items()} if medians else {}
    if modes:
        values = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in modes])).alias("entry")
        counts = train.select(values).select("entry.*").filter(F.col("value").isNotNull() & ~F.isnan("value")).groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))
        best = counts.groupBy("name").agg(F.max_by("value", F.struct("n", -F.col("value"))).alias("value"))
        fitted |= {c: None for c in modes} | {r.name: r.value for r in best.collect()}  # a row per column
    fills = {S.FLAG: DEFAULT_FLAG} if constants is None else constants
    return Imputer({**fitted, **fills})


def zero_fill(df: DataFrame, columns: list[str]) -> DataFrame:
    """Zero for null or NaN."""
    return df.withColumns({c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)) for c in columns})
