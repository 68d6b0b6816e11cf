"""The model report: comparison, best model, gains and success criteria as one markdown text."""

from pyspark.sql import DataFrame

from wayfare import session
from wayfare.operators import metrics


def markdown_report(board: DataFrame, title: str = "Model evaluation") -> str:
    """Markdown of a leaderboard. Only its rows, one per model, come to the driver."""
    rows = board.collect()
    checks = metrics.success_criteria(board).collect()
    best = next(r for r in rows if r.is_best)
    lines = [
        f"# {title}",
        "",
        f"Best model: **{best.model}**. RMSE {best.RMSE:.4f} min ({best.rmse_gain_pct:.1f}% below the baseline), "
        f"MAE {best.MAE:.4f} min ({best.mae_gain_pct:.1f}% below), R2 {best.R2:.4f} ({best.r2_gain:+.4f}).",
        "",
        "| Model | RMSE | MAE | R2 | MAPE % |",
        "|---|---|---|---|---|",
    ]
    for r in rows:
        name = f"{r.model} (best)" if r.is_best else r.model
        lines.append(f"| {name} | {r.RMSE:.4f} | {r.MAE:.4f} | {r.R2:.4f} | {r.MAPE:.2f} |")
    lines += ["", "| Criterion | Target | Achieved | Status |", "|---|---|---|---|"]
    lines += [f"| {c.criterion} | {c.target:.2f} | {c.achieved:.2f} | {c.status} |" for c in checks]
    return "\n".join(lines) + "\n"


def write_report(board: DataFrame, path: str, title: str = "Model evaluation") -> None:
    spark = board.sparkSession
    lines = markdown_report(board, title).splitlines()
    session.literal_rows(spark, [(line,) for line in lines], "value string").coalesce(1).write.mode("overwrite").text(path)
