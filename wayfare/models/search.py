"""Expanding-window validation, and random search whose finished fits are kept in a ledger."""

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from itertools import product
from math import prod

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare import schema as S
from wayfare import session
from wayfare.functions import trip
from wayfare.models.paths import exists
from wayfare.operators import metrics

SCORES = "candidate int, block int, rows long, RMSE double, MAE double, R2 double"


def points(spark: SparkSession, space: dict[str, list], n: int, seed: int = 42) -> DataFrame:
    """n different points of a grid, drawn without replacement; the whole grid if it is smaller.

    A point is a number whose mixed-radix digits are its places on the axes, the last axis running fastest. The n numbers with
    the lowest md5 of "seed:number" are taken: a row per point with its place in the draw (from 0), its number and one column per axis.
    """
    total = prod(len(axis) for axis in space.values())
    drawn = spark.range(total).withColumn("hash", F.md5(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string"))))
    kept = drawn.orderBy("hash").limit(min(n, total))
    digits, step = {}, total
    for name, axis in space.items():
        step //= len(axis)
        place = F.floor(F.col("id") / step) % len(axis)
        digits[name] = F.get(F.array(*[F.lit(v) for v in axis]), place.cast("int"))
    placed = kept.agg(F.sort_array(F.collect_list(F.struct("hash", "id"))).alias("all"))  # n entries
    listed = placed.select(F.posexplode("all").alias("draw", "of")).select("draw", F.col("of.id").alias("id"))
    return listed.select("draw", F.col("id").alias("number"), *[value.alias(name) for name, value in digits.items()])


def draws(spark: SparkSession, space: dict[str, list], n: int, seed: int = 42) -> list[dict]:
    """The same points as plain values, in the order drawn."""
    return [{name: r[name] for name in space} for r in points(spark, space, n, seed).orderBy("draw").collect()]


def grid(space: dict[str, list]) -> list[dict]:
    return [dict(zip(space, values)) for values in product(*space.values())]


def fold_scores(scored: DataFrame, name: str, label: str = S.TARGET, block: str = "block") -> DataFrame:
    """RMSE, MAE and R2 per block of ``prediction`` clipped at zero."""
    clipped = scored.withColumn("prediction", trip.clip(F.col("prediction"), low=0))
    return metrics.evaluate_models(clipped, label, {name: "prediction"}, [block], None)


def cross_validate(
    train: DataFrame, fit: Callable[[DataFrame], object] | Pipeline, name: str, label: str = S.TARGET, block: str = "block", folds: int | None = None
) -> DataFrame:
    """RMSE, MAE and R2 per fold: fit on blocks <= i, clip at zero, measure on block i + 1.

    ``fit`` is a pipeline, or takes a table and returns a model. ``train`` should be a stored table: each fold reads only the
    blocks it needs from it.
    """
    fit = fit.fit if isinstance(fit, Pipeline) else fit
    last = folds or train.agg(F.max(block)).first()[0]
    scored = None
    for held in range(1, last + 1):
        model = fit(train.filter(F.col(block) < held))
        fold = model.transform(train.filter(F.col(block) == held)).select(block, label, "prediction")
        scored = fold if scored is None else scored.unionByName(fold)
    return fold_scores(scored, name, label, block)


class Ledger:
    """Scores of finished (candidate, fold) fits, one small table each below a folder. A folder without its end mark is no entry."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def path(self, candidate: int, block: int) -> str:
        return f"{self.root}/{candidate:04d}-{block:02d}"

    def has(self, candidate: int, block: int) -> bool:
        return exists(self.spark, f"{self.path(candidate, block)}/_SUCCESS")

    def add(self, candidate: int, scores: DataFrame) -> None:
        r = scores.first()
        row = (candidate, int(r["block"]), int(r["rows"]), float(r["RMSE"]), float(r["MAE"]), float(r["R2"]))
        self.spark.createDataFrame([row], SCORES).coalesce(1).write.mode("overwrite").parquet(self.path(candidate, row[1]))

    def read(self, candidates: int, folds: int) -> DataFrame:
        """The entries of the given candidates and folds; other entries of the folder are left out."""
        found = [self.path(c, b) for c in range(candidates) for b in range(1, folds + 1) if self.has(c, b)]
        return self.spark.read.schema(SCORES).parquet(*found) if found else self.spark.createDataFrame([], SCORES)


def search(
    train: DataFrame,
    candidates: list[tuple[str, Callable[[DataFrame, str], object] | Pipeline]],
    parallelism: int = 2,
    label: str = S.TARGET,
    ledger: str | None = None,
    block: str = "block",
) -> DataFrame:
    """Validation scores of every candidate, lowest mean RMSE first, then in candidate order.

    A candidate is a pipeline, or a function of the training rows and a folder of its own that returns a model. Every (candidate,
    fold) is entered in the ledger when it is done, and one that is there already is not fitted again: a search that was cut off
    goes on where it stopped and ends with the same board. Fits run from a small pool of driver threads, so short stages of one
    fill the executors that another leaves idle.
    """
    spark = train.sparkSession
    book = Ledger(spark, ledger or session.scratch_path(spark, "ledger"))
    folds = train.agg(F.max(block)).first()[0] or 0

    def run(task: tuple[int, int]) -> None:
        number, held = task
        if book.has(number, held):
            return
        name, fit = candidates[number]
        past, now = train.filter(F.col(block) < held), train.filter(F.col(block) == held)
        model = fit.fit(past) if isinstance(fit, Pipeline) else fit(past, f"{book.root}/fits/{number:04d}-{held:02d}")
        book.add(number, fold_scores(model.transform(now).select(block, label, "prediction"), name, label, block))

    with ThreadPoolExecutor(parallelism) as pool:
        list(pool.map(run, product(range(len(candidates)), range(1, folds + 1))))
    names = spark.createDataFrame([(i, name) for i, (name, _) in enumerate(candidates)], "candidate int, model string")
    entries = book.read(len(candidates), folds).join(F.broadcast(names), "candidate")  # a row per candidate on the small side
    return metrics.fold_summary(entries, ["candidate", "model"]).orderBy("RMSE_mean", "candidate")
