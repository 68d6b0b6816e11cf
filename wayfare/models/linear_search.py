"""Validation of linear models from second moments: a whole grid without one fit per fold.

A least-squares or ridge fit needs only counts, means and covariances of inputs and label, and these
add up over time blocks. They are collected once per block; every fold and penalty is then a small
solve, in place of a pass over the data for each. Squared errors of unclipped predictions follow from the same
moments, so the grid search itself needs no further pass.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare import schema as S
from wayfare.functions import trip
from wayfare.operators import metrics


@dataclass(frozen=True)
class Moments:
    """Row count, means and centred cross products of inputs and label (last)."""

    rows: int
    mean: np.ndarray
    scatter: np.ndarray

    def __add__(self, other: "Moments") -> "Moments":
        rows = self.rows + other.rows
        shift = other.mean - self.mean
        scatter = self.scatter + other.scatter + np.outer(shift, shift) * (self.rows * other.rows / rows)
        return Moments(rows, self.mean + shift * (other.rows / rows), scatter)


def block_moments(df: DataFrame, columns: list[str], label: str = S.TARGET, block: str = "block") -> dict[int, Moments]:
    """Moments of each time block, in two passes whatever the number of blocks.

    The first pass standardises inputs and label over all rows, which keeps the sums well
    conditioned; the second multiplies them batch by batch. A task sends one matrix of input pairs per block it
    meets, these add up in a shuffle, and only one per block reaches the driver. A missing input or label is an error.
    """
    names = [*columns, label]
    vectors = VectorAssembler(inputCols=names, outputCol="raw").transform(df).select("raw")
    scaler = StandardScaler(inputCol="raw", outputCol="z", withMean=True, withStd=True).fit(vectors)
    centre, spread = scaler.mean.toArray(), scaler.std.toArray()
    scale = np.divide(1.0, spread, out=np.zeros_like(spread), where=spread > 0)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]], axis=1)
            if np.isnan(x).any():
                raise ValueError("inputs and label must not be missing")
            z, of = (x - centre) * scale, batch.column(0).to_numpy()
            for key in np.unique(of).tolist():
                part = z[of == key]
                found[key] = found.get(key, 0.0) + np.concatenate([[len(part)], part.sum(axis=0), (part.T @ part).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array([list(v) for v in found.values()], pa.list_(pa.float64()))], ["block", "sums"])

    rows = df.select(F.col(block).cast("int").alias("block"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(names)])
    added = rows.mapInArrow(sums, "block int, sums array<double>").select("block", F.posexplode("sums"))
    totals: dict[int, np.ndarray] = {}
    size = len(names)
    for row in added.groupBy("block", "pos").agg(F.sum("col").alias("total")).collect():  # one matrix per block
        totals.setdefault(row.block, np.zeros(1 + size + size * size))[row.pos] = row.total
    result = {}
    for key in sorted(totals):
        n, means, pairs = int(totals[key][0]), totals[key][1 : 1 + size] / totals[key][0], totals[key][1 + size :].reshape(size, size)
        result[key] = Moments(n, centre + means * spread, (pairs - np.outer(means, means) * n) * np.outer(spread, spread))
    return result


@dataclass(frozen=True)
class Line:
    weights: np.ndarray
    intercept: float

    def squared_error(self, on: Moments) -> float:
        """Mean squared error over the rows behind the moments."""
        step = np.append(self.weights, -1.0)
        bias = self.intercept + step @ on.mean
        return float(step @ on.scatter @ step / on.rows + bias * bias)


def solve(moments: Moments, alpha: float = 0.0) -> Line:
    """Ridge on inputs scaled to unit population deviation; least norm for a zero penalty."""
    xx, xy = moments.scatter[:-1, :-1], moments.scatter[:-1, -1]
    scale = np.sqrt(np.diag(xx) / moments.rows)
    scale[scale == 0] = 1.0
    gram, target = xx / np.outer(scale, scale), xy / scale
    if alpha:
        weights = np.linalg.solve(gram + alpha * np.eye(len(scale)), target)
    else:
        weights = np.linalg.pinv(gram, rcond=1e-11, hermitian=True) @ target
    weights = weights / scale
    return Line(weights, float(moments.mean[-1] - weights @ moments.mean[:-1]))


def expanding_folds(moments: dict[int, Moments]) -> list[tuple[int, Moments, Moments]]:
    """(validation block, moments of all earlier blocks, moments of the validation block)."""
    folds, earlier = [], moments[0]
    for block in range(1, len(moments)):
        folds.append((block, earlier, moments[block]))
        earlier = earlier + moments[block]
    return folds


def grid_scores(moments: dict[int, Moments], alphas: list[float]) -> list[tuple[float, float]]:
    """(alpha, mean validation RMSE over the folds), in grid order."""
    folds = expanding_folds(moments)
    return [
        (alpha, float(np.mean([np.sqrt(solve(train, alpha).squared_error(held)) for _, train, held in folds])))
        for alpha in alphas
    ]


def best_alpha(scores: list[tuple[float, float]]) -> float:
    """Penalty with the least error; the first in the grid on ties."""
    return min(scores, key=lambda s: s[1])[0]


def fold_predictions(df: DataFrame, columns: list[str], moments: dict[int, Moments], alpha: float = 0.0, block: str = "block") -> DataFrame:
    """Out-of-fold predictions: each row is scored by the fit on all earlier blocks, in one pass.

    The weights of the few folds are literals in the plan, so nothing is joined.
    """
    prediction = F.lit(None).cast("double")
    for number, train, _ in expanding_folds(moments):
        line = solve(train, alpha)
        terms = [F.col(c) * F.lit(float(w)) for c, w in zip(columns, line.weights)]
        prediction = F.when(F.col(block) == number, sum(terms, F.lit(line.intercept))).otherwise(prediction)
    return df.filter(F.col(block) > 0).withColumn("prediction", prediction)


def fold_metrics(df: DataFrame, columns: list[str], moments: dict[int, Moments], alpha: float = 0.0, label: str = S.TARGET) -> DataFrame:
    """RMSE, MAE and R2 of each fold, predictions clipped at zero."""
    scored = fold_predictions(df, columns, moments, alpha)
    return metrics.evaluate_models(
        scored.withColumn("prediction", trip.clip(F.col("prediction"), low=0)), label, {"linear": "prediction"}, ["block"], None
    )
