import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayfare.operators import metrics
from wayfare.plans import report


def measure(spark, actual, predicted, round_to=None):
    df = spark.createDataFrame([tuple(map(float, pair)) for pair in zip(actual, predicted)], "y double, p double")
    return metrics.evaluate_models(df, "y", {"m": "p"}, round_to=round_to).first()


def test_perfect_predictions(spark):
    m = measure(spark, [10, 20, 30, 40, 50], [10, 20, 30, 40, 50])
    assert (m.RMSE, m.MAE, m.R2, m.MAPE) == (0, 0, 1, 0)


def test_predicting_the_mean(spark):
    assert measure(spark, [10, 20, 30, 40, 50], [30] * 5).R2 == pytest.approx(0)


def test_against_numpy(spark):
    rng = np.random.default_rng(0)
    y = rng.random(100) * 60
    y[:3] = 0
    p = np.clip(y + rng.normal(0, 5, 100), 0, None)
    m = measure(spark, y, p)
    assert m.RMSE == pytest.approx(np.sqrt(np.mean((y - p) ** 2))) and m.RMSE >= 0
    assert m.MAE == pytest.approx(np.mean(np.abs(y - p)))
    assert m.R2 == pytest.approx(1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2))
    assert m.MAPE == pytest.approx(np.mean(np.abs((y - p) / y)[y != 0]) * 100)


def test_metric_names_and_rounding(spark):
    m = measure(spark, [15, 22, 10], [14, 23, 10.33333], 4)
    assert {"RMSE", "MAE", "R2", "MAPE"} <= set(m.asDict())
    assert m.MAE == round(m.MAE, 4)


@pytest.mark.parametrize("predicted,r2", [([5, 5], 1.0), ([5, 6], 0.0)])
def test_constant_target(spark, predicted, r2):
    assert measure(spark, [5, 5], predicted).R2 == r2


def test_negative_predictions_are_clipped(spark):
    assert measure(spark, [1, 2], [-5, 2]).MAE == 0.5


def test_missing_predictions_do_not_count(spark):
    df = spark.createDataFrame([(1.0, 2.0), (100.0, None)], "y double, p double")
    m = metrics.evaluate_models(df, "y", {"m": "p"}).first()
    assert (m.MAE, m.RMSE) == (1.0, 1.0)


@pytest.fixture
def board(spark):
    rows = [("baseline", 10, 12.0, 8.0, 0.10, 50.0), ("a", 10, 6.0, 4.0, 0.70, 20.0), ("b", 10, 4.0, 2.0, 0.90, 10.0)]
    return metrics.leaderboard(
        spark.createDataFrame(rows, "model string, rows bigint, RMSE double, MAE double, R2 double, MAPE double")
    )


def test_leaderboard(board):
    rows = board.collect()
    assert [r.model for r in rows] == ["b", "a", "baseline"]
    assert [r.is_best for r in rows] == [True, False, False]
    assert (rows[0].rmse_gain_pct, rows[0].mae_gain_pct, rows[0].r2_gain) == (66.6667, 75.0, 0.8)


def test_baseline_is_never_best(spark):
    rows = [("baseline", 1.0, 1.0, 1.0), ("a", 2.0, 2.0, 0.5)]
    best = metrics.leaderboard(spark.createDataFrame(rows, "model string, RMSE double, MAE double, R2 double"))
    assert {r.model: r.is_best for r in best.collect()} == {"baseline": False, "a": True}


def test_success_criteria(board):
    assert {r.criterion: r.status for r in metrics.success_criteria(board).collect()} == dict.fromkeys(
        ["RMSE", "MAE", "R2", "beats_baseline"], "PASS"
    )


def test_report(spark, board, tmp_path):
    text = report.markdown_report(board)
    assert "b (best)" in text and text.count("PASS") == 4
    report.write_report(board, str(tmp_path / "report"))
    assert [r.value for r in spark.read.text(str(tmp_path / "report")).collect()] == text.splitlines()


def test_residual_summary(spark):
    rng = random.Random(0)
    pairs = [(float(i), i + rng.uniform(-8, 8)) for i in range(200)]
    s = metrics.residual_summary(spark.createDataFrame(pairs, "y double, p double"), "y", "p").first()
    errors = np.array([p - y for y, p in pairs])
    assert s.mean_error == pytest.approx(errors.mean(), abs=1e-6)
    assert s.std_error == pytest.approx(errors.std(), abs=1e-6)
    assert s.within_5_pct == pytest.approx(100 * np.mean(np.abs(errors) <= 5), abs=1e-4)


def test_fold_summary_uses_population_deviation(spark):
    folds = spark.createDataFrame([("m", 1.0, 2.0, 0.5), ("m", 3.0, 4.0, 0.7)], "model string, RMSE double, MAE double, R2 double")
    s = metrics.fold_summary(folds, ["model"]).first()
    assert (s.folds, s.RMSE_mean, s.RMSE_std, s.R2_std) == (2, 2.0, 1.0, 0.1)


def test_error_groups_leave_out_empty_ones(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 4.0), (3, 1.0)], "k int, abs_error double")
    assert sorted(tuple(r) for r in metrics.mean_error_by(df, "k").collect()) == [(1, 2, 3.0), (3, 1, 1.0)]
    assert df.filter(F.col("k") == 2).count() == 0
