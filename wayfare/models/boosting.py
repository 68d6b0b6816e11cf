"""Boosted trees fitted round by round: early stopping inside the fit, penalised leaves, and restarts from saved rounds.

Every round fits one library tree to the residuals of a sample of rows and columns. One aggregate per round then gives
each leaf its value, the soft-thresholded sum of residuals over count plus penalty, and the held-out error after the round at
the same time. Predictions so far live in a table that is written anew every few rounds, so a round reads
features and applies a few trees, never the whole ensemble. Finished rounds are saved in parts below a folder; a fit that finds parts
there goes on after them and ends with the same model as one that was never interrupted.

Rows that agree in every input share their prediction, so trees and errors need no more of them than their number, the mean of their labels
and the deviation from it. Where inputs are few beside the rows and rounds sample no rows, one pass sums the rows up and all
rounds run on the sums; else rounds run on the rows.
"""

import math
import random
from dataclasses import asdict, dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare import schema as S
from wayfare import session
from wayfare.models.paths import exists
from wayfare.models.pipelines import PATIENCE, SEED

RUNNING, INPUTS, LEAF, RESIDUAL = "_running", "_inputs", "_leaf", "_residual"
HELD, ROW = "_held", "_row"
ROWS, MEAN, VARIANCE = "_rows", "_mean", "_variance"
STAGED_ROUNDS = 10  # trees applied on the way before the running prediction is written anew
ALIKE = 10  # rows of equal inputs, on average, from which they are summed up
SHARES = 10_000


@dataclass(frozen=True)
class Settings:
    """How an ensemble is grown. ``patience`` None grows all rounds on all rows; else the latest time block is held out."""

    rounds: int = 500
    rate: float = 0.05
    depth: int = 7
    min_rows: int = 50
    row_share: float = 0.8
    column_share: float = 0.8
    l1: float = 0.1
    l2: float = 1.0
    patience: int | None = PATIENCE
    bins: int = 255
    seed: int = SEED
    part: int = 50  # rounds saved together


# Fixed settings of the two boosted models: A has 127 leaves (depth 7 holds 128), B depth 8.
PRESETS = {"A": Settings(), "B": Settings(depth=8)}


def settings_of(draw: dict, **more) -> Settings:
    """Settings of one point of the search space. Trees grow level by level, so a leaf limit is the depth that holds as many."""
    by_leaves = math.ceil(math.log2(draw["num_leaves"]))
    return Settings(
        rounds=draw["n_estimators"],
        rate=draw["learning_rate"],
        depth=by_leaves if draw["max_depth"] < 0 else min(by_leaves, draw["max_depth"]),
        min_rows=draw["min_child_samples"],
        row_share=draw["subsample"],
        column_share=draw["colsample_bytree"],
        l1=draw["reg_alpha"],
        l2=draw["reg_lambda"],
        **{"patience": None, **more},
    )


@dataclass
class Round:
    """One tree with its inputs, and the value of each leaf (before the rate)."""

    assembler: VectorAssembler
    tree: object
    values: list[float]

    def leaves(self, df: DataFrame) -> DataFrame:
        return self.tree.transform(self.assembler.transform(df)).drop(INPUTS)

    def add(self, df: DataFrame, rate: float) -> DataFrame:
        """The running prediction after this round."""
        step = F.get(F.lit(self.values), F.col(LEAF).cast("int")) * rate
        return self.leaves(df).withColumn(RUNNING, F.col(RUNNING) + step).drop(LEAF)


@dataclass
class Ensemble:
    """A fitted ensemble: the training mean, the rounds, and the held-out squared error after each (before the first: ``start``)."""

    base: float
    rate: float
    rounds: list[Round] = field(default_factory=list)
    errors: list[float] = field(default_factory=list)
    kept: int = 0

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``prediction`` from the rounds that are kept."""
        scored = df.withColumn(RUNNING, F.lit(self.base))
        for one in self.rounds[: self.kept]:
            scored = one.add(scored, self.rate)
        return scored.withColumnRenamed(RUNNING, "prediction")


def best_round(errors: list[float], patience: int | None) -> tuple[int, bool]:
    """Rounds to keep, and whether growing is over: the lowest error so far, once ``patience`` rounds brought no lower one."""
    if patience is None:
        return len(errors), False
    best = 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return min(best + 1, len(errors)), False


def leaf_value(total: float, rows: int, settings: Settings) -> float:
    """Residual sum moved towards zero by ``l1``, over rows plus ``l2``."""
    return math.copysign(max(abs(total) - settings.l1, 0.0), total) / (rows + settings.l2) if rows + settings.l2 else 0.0


def chosen_columns(columns: list[str], settings: Settings, at: int) -> list[str]:
    """The columns of one round, in their order: a share of all, at least one, drawn by seed and round."""
    n = max(1, int(len(columns) * settings.column_share + 1e-9))
    picked = set(random.Random(settings.seed * 1_000_003 + at).sample(range(len(columns)), n))
    return [c for i, c in enumerate(columns) if i in picked]


def in_sample(settings: Settings, at: int) -> Column:
    """Whether a row is in the sample of one round: a hash of the row and the round, so a repeated round draws the same rows."""
    if settings.row_share >= 1:
        return F.lit(True)
    place = F.pmod(F.xxhash64(F.col(ROW), F.lit(settings.seed), F.lit(at)), F.lit(SHARES))
    return place < int(settings.row_share * SHARES + 0.5)


class _Parts:
    """Saved parts of a fit: trees, leaf values and errors; the errors are written last and make a part whole."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def path(self, number: int, what: str) -> str:
        return f"{self.root}/part-{number:04d}/{what}"

    def save(self, number: int, first: int, rounds: list[Round], errors: list[float]) -> None:
        stages = [stage for one in rounds for stage in (one.assembler, one.tree)]
        PipelineModel(stages).write().overwrite().save(self.path(number, "trees"))
        values = [(first + i, leaf, v) for i, one in enumerate(rounds) for leaf, v in enumerate(one.values)]
        self._write(values, "round int, leaf int, value double", self.path(number, "values"))
        self._write([(first + i, e) for i, e in enumerate(errors)], "round int, error double", self.path(number, "errors"))

    def _write(self, rows: list[tuple], schema: str, path: str) -> None:
        self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(path)

    def load(self) -> tuple[list[Round], list[float], int]:
        """Rounds and errors of all whole parts, and how many parts there are."""
        rounds, errors, number = [], [], 0
        while exists(self.spark, self.path(number, "errors/_SUCCESS")):
            stages = PipelineModel.load(self.path(number, "trees")).stages
            values: dict[int, list[float]] = {}
            for r in self.spark.read.parquet(self.path(number, "values")).orderBy("round", "leaf").collect():  # leaves of a part
                values.setdefault(r["round"], []).append(r["value"])
            rounds += [Round(a, t, values[k]) for a, t, k in zip(stages[::2], stages[1::2], sorted(values))]
            errors += [r["error"] for r in self.spark.read.parquet(self.path(number, "errors")).orderBy("round").collect()]
            number += 1
        return rounds, errors, number

    def check(self, described: dict) -> None:
        """A folder belongs to one kind of fit; going on with other settings or inputs is an error."""
        path = f"{self.root}/settings"
        text = ", ".join(f"{k}={v}" for k, v in described.items())
        if exists(self.spark, f"{path}/_SUCCESS"):
            found = self.spark.read.text(path).first()[0]
            if found != text:
                raise ValueError(f"{self.root} holds a fit with other settings: {found}")
        else:
            self.spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def _summed(table: DataFrame, columns: list[str], label: str) -> DataFrame:
    """A row for all rows that agree in every input and in being held out: their number, and mean and variance of their labels."""
    y = F.col(label).cast("double")
    return table.groupBy(*columns, HELD).agg(F.count(F.lit(1)).alias(ROWS), F.avg(y).alias(MEAN), F.var_pop(y).alias(VARIANCE))


def _grown(current: DataFrame, columns: list[str], label: str, settings: Settings, rows: int, at: int) -> Round:
    """The tree of one round. ``rows`` are all rows to grow on, and only asked for where ``current`` holds sums."""
    picked = chosen_columns(columns, settings, at)
    assembler = VectorAssembler(inputCols=picked, outputCol=INPUTS, handleInvalid="error")
    sample = current.filter(~F.col(HELD) & in_sample(settings, at)).withColumn(RESIDUAL, F.col(label) - F.col(RUNNING))
    trees = DecisionTreeRegressor(featuresCol=INPUTS, labelCol=RESIDUAL, leafCol=LEAF, maxDepth=settings.depth, maxBins=settings.bins, seed=settings.seed + at)
    if ROWS in current.columns:
        # two points on either side of the mean, each for half of the rows, have the rows' count, sum and sum of squares
        away = F.sqrt(VARIANCE)
        sample = sample.withColumn(RESIDUAL, F.explode(F.array(F.col(RESIDUAL) - away, F.col(RESIDUAL) + away))).withColumn(ROWS, F.col(ROWS) / 2)
        # counts are whole numbers, so a limit between two of them is safe from rounding; from half of all rows on no split is left
        least = (settings.min_rows - 0.5) / rows
        trees.setWeightCol(ROWS).setMinWeightFractionPerNode(least if least < 0.5 else 0.0)
        trees.setMaxDepth(settings.depth if least < 0.5 else 0)
        points = assembler.transform(sample).select(INPUTS, RESIDUAL, ROWS)
    else:
        trees.setMinInstancesPerNode(settings.min_rows)
        points = assembler.transform(sample).select(INPUTS, RESIDUAL)
    tree = trees.fit(points)
    tree.setPredictionCol("")
    return Round(assembler, tree, [])


def _measured(current: DataFrame, one: Round, label: str, settings: Settings, at: int) -> float:
    """Set the leaf values of a round and return the sum of squared errors of the held-out rows after it. One aggregate."""
    rest = F.col(label) - F.col(RUNNING)
    rows, variance = (F.col(ROWS), F.col(VARIANCE)) if ROWS in current.columns else (F.lit(1), F.lit(0.0))
    kind = F.when(F.col(HELD), F.lit(2)).when(in_sample(settings, at), F.lit(1)).otherwise(F.lit(0))
    sums = one.leaves(current).groupBy(F.col(LEAF).cast("int").alias("leaf"), kind.alias("kind"))
    found = sums.agg(F.sum(rows).alias("n"), F.sum(rows * rest).alias("s"), F.sum(rows * (rest * rest + variance)).alias("ss")).collect()  # a few rows a leaf
    leaves = (one.tree.numNodes + 1) // 2
    one.values = [0.0] * leaves
    for r in found:
        if r["kind"] == 1:
            one.values[r["leaf"]] = leaf_value(r["s"], r["n"], settings)
    steps = [(r, settings.rate * one.values[r["leaf"]]) for r in found if r["kind"] == 2]
    return math.fsum(r["ss"] - 2 * step * r["s"] + step * step * r["n"] for r, step in steps)


def fit(train: DataFrame, columns: list[str], settings: Settings, root: str | None = None, label: str = S.TARGET, block: str = "block") -> Ensemble:
    """Grow an ensemble on ``train`` (columns, label, block), which should be a stored table.

    With patience, the latest block is held out: growing ends when ``patience`` rounds brought no lower held-out error, and
    the rounds up to the lowest are kept. Rounds are saved below ``root``; a fit that was cut off
    goes on after the last whole part. A label that is null takes no part; a null input is an error.
    """
    spark = train.sparkSession
    root = root or session.scratch_path(spark, "boosting")
    parts = _Parts(spark, root)
    parts.check({**asdict(settings), "label": label, "columns": " ".join(columns)})
    train = train.filter(F.col(label).isNotNull())

    def staged(df: DataFrame) -> DataFrame:
        path = session.scratch_path(spark, "running")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    asked = {}
    if settings.patience is not None:
        asked["latest"] = F.max(block)
    if settings.row_share >= 1:
        asked |= {"rows": F.count(F.lit(1)), "inputs": F.approx_count_distinct(F.xxhash64(*columns))}
    told = train.agg(*[c.alias(name) for name, c in asked.items()]).first().asDict() if asked else {}
    held = F.col(block) == F.lit(told["latest"]) if "latest" in told else F.lit(False)
    table = train.select(*[F.col(c) for c in dict.fromkeys([*columns, label])], F.coalesce(held, F.lit(False)).alias(HELD))
    weight = F.lit(1)
    if settings.row_share < 1:
        table = table.withColumn(ROW, F.xxhash64(*columns, label))
    elif told["rows"] >= ALIKE * told["inputs"]:
        table, label, weight = staged(_summed(table, columns, label)), MEAN, F.col(ROWS)
    grown, held = ~F.col(HELD), F.col(HELD)
    total = F.sum(F.when(grown, weight * F.col(label).cast("double")))
    rows, total, held_rows = table.agg(F.sum(F.when(grown, weight)), total, F.sum(F.when(held, weight))).first()
    base = total / rows if rows else None
    model = Ensemble(base if base is not None else 0.0, settings.rate)
    model.rounds, model.errors, number = parts.load()
    if base is None:
        return model
    model.kept, over = best_round(model.errors, settings.patience)
    saved = len(model.rounds)

    current = table.withColumn(RUNNING, F.lit(model.base))
    for i, one in enumerate(model.rounds):
        current = one.add(current, settings.rate)
        if (i + 1) % STAGED_ROUNDS == 0:
            current = staged(current)
    current = staged(current) if not over else current
    while not over and len(model.rounds) < settings.rounds:
        at = len(model.rounds)
        one = _grown(current, columns, label, settings, rows, at)
        error = _measured(current, one, label, settings, at)
        model.rounds.append(one)
        model.errors.append(error / held_rows if held_rows else math.nan)
        current = one.add(current, settings.rate)
        if (at + 1) % STAGED_ROUNDS == 0:
            current = staged(current)
        model.kept, over = best_round(model.errors, settings.patience if held_rows else None)
        if over or len(model.rounds) - saved == settings.part or len(model.rounds) == settings.rounds:
            parts.save(number, saved, model.rounds[saved:], model.errors[saved:])
            number, saved = number + 1, len(model.rounds)
    return model


def load(spark: SparkSession, root: str, base: float, settings: Settings) -> Ensemble:
    """The ensemble saved below a folder, as far as it was grown."""
    rounds, errors, _ = _Parts(spark, root).load()
    return Ensemble(base, settings.rate, rounds, errors, best_round(errors, settings.patience)[0])


def error_curve(model: Ensemble, spark: SparkSession) -> DataFrame:
    """Held-out root mean squared error after each round, and whether the round is kept. A row per round."""
    rows = [(i + 1, math.sqrt(e) if e == e else None, i < model.kept) for i, e in enumerate(model.errors)]
    return spark.createDataFrame(rows, "round int, RMSE double, kept boolean")


def part_folders(root: str) -> str:
    """Where the trees of a fit saved below ``root`` lie, for ``importance.nodes``."""
    return f"{root}/part-*/trees"
