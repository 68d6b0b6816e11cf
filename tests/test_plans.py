"""Physical plans: what is pushed down, broadcast and shuffled."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import executed_plan
from wayfare import schema as S
from wayfare import session
from wayfare.functions import time as calendar
from wayfare.functions import trip
from wayfare.operators import profiling, quality, split
from wayfare.plans import catalog, features, prepare


def exchanges(df) -> int:
    return len(re.findall(r"\bExchange (?:hash|range|Round)", executed_plan(df)))


def test_cleaning_rules_reach_the_scan(ws):
    plan = executed_plan(prepare.prepare(ws.raw()))
    for pushed in (
        "GreaterThanOrEqual(trip_distance,0.1)",
        "LessThanOrEqual(trip_distance,100.0)",
        "GreaterThanOrEqual(PULocationID,1)",
        "GreaterThanOrEqual(fare_amount,0.0)",
    ):
        assert pushed in plan


def test_cleaning_shuffles_once_and_only_for_duplicates(ws):
    assert exchanges(prepare.prepare(ws.raw())) == 1
    assert exchanges(prepare.prepare(ws.raw(), dedup=False)) == 0


def test_copies_are_found_without_shuffling_derived_columns(ws):
    plan = executed_plan(prepare.prepare(ws.raw()))
    keys = re.search(r"Exchange hashpartitioning\(([^)]*)", plan).group(1)
    assert S.DROPOFF in keys and S.TARGET not in keys and S.SECONDS not in keys


def test_training_period_prunes_partitions(ws):
    plan = executed_plan(ws.train().select(S.DISTANCE))
    assert re.search(r"PartitionFilters: \[[^\]]*year", plan)
    assert S.FARE not in plan.split("ReadSchema")[-1]


def test_features_are_broadcast_lookups_without_a_shuffle(ws):
    plan = executed_plan(ws.test_features())
    assert plan.count("BroadcastHashJoin") == 3
    assert exchanges(ws.test_features()) == 0 and "SortMergeJoin" not in plan


def test_route_statistics_shuffle_trips_once_and_then_only_counts(ws):
    df = features.route_seconds(ws.train())
    plan = executed_plan(df)
    assert exchanges(df) == 1 and plan.count("HashAggregate") == 2
    assert "hashpartitioning(PULocationID" in plan


def test_top_zones_take_ordered_before_the_lookup(ws):
    plan = executed_plan(profiling.top_zones(ws.train(), S.PU, ws.zones()))
    assert "TakeOrderedAndProject" in plan
    assert plan.index("BroadcastHashJoin") < plan.index("TakeOrderedAndProject")


def test_audit_is_one_pass(ws):
    df = quality.filter_audit(trip.with_duration(ws.raw().select(*S.TRIP_COLUMNS)))
    assert executed_plan(df).count("FileScan") == 1


def test_time_features_stay_inside_generated_code(ws):
    df = calendar.with_cyclic_features(calendar.with_time_features(ws.test()))
    plan = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen"))
    assert "WholeStageCodegen" in plan or "Found 1 WholeStageCodegen subtrees" in plan


def test_folds_reach_the_scan(ws):
    blocks = split.with_time_blocks(ws.train(), 5)
    assert "LessThan" in executed_plan(blocks.filter(F.col("block") < 1))


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - {"stream_score", "stream_score_1d"}))
def test_no_python_and_no_cartesian_product(spark, sf_dir, name):
    plan = executed_plan(catalog.QUERIES[name](spark, sf_dir))
    for forbidden in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin", "Window"):
        assert forbidden not in plan


def test_a_closed_workspace_leaves_nothing(spark):
    import os

    from wayfare.plans.workspace import Workspace

    ws, other = Workspace(spark, "/root/testdata/sf0.001"), Workspace(spark, "/root/testdata/sf0.001")
    assert ws.raw().count() == other.raw().count() > 0 and os.path.exists(ws.root)
    ws.close()
    assert not os.path.exists(os.path.dirname(ws.root)) and other.raw().count() > 0
    other.close()


def star_tables(spark, folder) -> str:
    """Order lines with null, unknown and repeated keys, some of them equal trips."""
    day = "timestamp_ntz'1998-03-30 00:00:00'"
    tables = {
        "customer": "select id c_custkey, int(id % 9) c_nationkey from range(9) union all select null, 3",
        "supplier": "select id s_suppkey, int(id % 7) s_nationkey from range(19) union all select 5L, 6",
        "orders": f"select nullif(id, 70) o_orderkey, id % 11 o_custkey, timestampadd(DAY, int(id % 5), {day}) o_orderdate from range(99)",
        "lineitem": """select nullif(id % 103, 7) l_orderkey, id % 13 l_partkey, nullif(id % 23, 4) l_suppkey, int(id % 7 + 1) l_linenumber,
            double(id % 50 + 1) l_quantity, double(id % 40) * 200 l_extendedprice, double(id % 11) / 100 l_discount,
            if(id % 3 = 0, 'F', 'O') l_linestatus from range(2000) union all select 50L, 2L, 5L, 3, 9D, 4000D, 0.05D, 'F' from range(40)""",
    }
    for name, text in tables.items():
        spark.sql(text).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_cleaning_needs_no_raw_table_of_its_own(spark, tmp_path):
    import os

    from wayfare.plans.workspace import Workspace

    folder = star_tables(spark, tmp_path)
    alone, after = (Workspace(spark, folder) for _ in range(2))
    try:
        direct = alone.clean_unfilled()
        assert not os.path.exists(alone.path("raw"))
        after.raw()
        staged = after.clean_unfilled()
        assert os.path.exists(after.path("raw")) and direct.schema == staged.schema
        assert direct.count() == staged.count() > 0 and direct.exceptAll(staged).isEmpty()
    finally:
        alone.close()
        after.close()


def test_staged_writes_run_in_tasks_of_bounded_size(spark):
    parts, size = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.files.maxPartitionBytes"
    before = [spark.conf.get(key, None) for key in (parts, size)]
    with session.small_tasks(spark, 1_000 * session.TASK_ROWS):
        assert before[0] or int(spark.conf.get(parts)) >= 1_000
        assert before[1] or spark.conf.get(size) == "8m"
    assert [spark.conf.get(key, None) for key in (parts, size)] == before


def test_artifacts_are_fitted_in_tasks_of_bounded_size(spark, monkeypatch):
    from wayfare.plans.workspace import Workspace

    ws, size, seen = Workspace(spark, "/root/testdata/sf0.001"), "spark.sql.files.maxPartitionBytes", []
    before, fit = spark.conf.get(size, None), features.fit
    monkeypatch.setattr(features, "fit", lambda *given: seen.append(spark.conf.get(size, None)) or fit(*given))
    try:
        assert ws.artifacts.routes.count() >= 0
        assert seen == [before or "8m"] and spark.conf.get(size, None) == before
    finally:
        ws.close()


def test_what_the_session_sets_itself_stays(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "5m")
    try:
        with session.small_tasks(spark, 10):
            assert spark.conf.get(key) == "5m"
        assert spark.conf.get(key) == "5m"
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)
