"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data (default /root/testdata/sf0.1), BENCH_CPUS the local cores. Staging, the
part of a run that writes the hand-over tables, is timed on its own; queries then run to a sink
that discards rows. Each query runs twice: ``queries`` holds the second run, ``first_run`` the first,
which also pays for class loading and code generation. With BENCH_QUERIES=all, every registered
query runs.
"""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from wayfare.plans import catalog  # noqa: E402
from wayfare.plans.workspace import workspace  # noqa: E402
from wayfare.session import build_session  # noqa: E402

HEADLINE = [
    "clean_trips",
    "dedup",
    "filter_audit",
    "null_counts",
    "route_stats",
    "route_coverage",
    "feature_matrix",
    "describe_duration",
    "avg_by_hour",
    "heatmap_hour_dow",
    "corr_matrix",
    "hist_duration",
    "box_by_ratecode",
    "avg_speed",
    "top_pickup_zones",
    "sample_trips",
    "ts_split",
    "baseline_metrics",
    "leaderboard",
    "err_by_distance",
    "residual_summary",
    "score_validate",
    "score_baseline",
    "stream_score_baseline",
    "ols",
    "ridge_grid",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    wanted = list(catalog.QUERIES) if os.environ.get("BENCH_QUERIES") == "all" else HEADLINE
    spark = build_session(
        "wayfare-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "6g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1_000_000).selectExpr("sum(id)").collect()  # start the executors before the clock
    ws, took, first = workspace(spark, sf_dir), {}, {}

    def timed(times, name, action):
        start = time.perf_counter()
        action()
        times[name] = round(time.perf_counter() - start, 3)

    def run(name):
        ws.forget_models()  # a query of a model is timed with its fit
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    timed(took, "stage_raw", ws.raw)
    timed(took, "stage_clean", ws.clean)
    timed(took, "stage_artifacts", lambda: ws.artifacts)
    timed(took, "stage_matrix", ws.train_matrix)
    for name in wanted:
        timed(first, name, lambda: run(name))
        timed(took, name, lambda: run(name))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "staging once plus headline queries, second run",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "first_run": first,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
