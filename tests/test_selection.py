import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import executed_plan
from wayfare import schema as S
from wayfare.operators import profiling, sampling, selection, split


def one_column(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


@pytest.mark.parametrize("seed", range(3))
def test_ranks_against_a_sort(spark, seed):
    rng = random.Random(seed)
    # a third of the rows share one value
    values = [rng.choice([7.25, rng.uniform(-1e6, 1e6), float(rng.randint(0, 50))]) for _ in range(600)]
    ordered = sorted(values)
    ranks = [0, 1, 150, 299, 300, 598, 599]
    found = selection.locate_ranks(one_column(spark, [*values, None]), F.col("x"), ranks, bins=7)
    for rank in ranks:
        spot = found[rank]
        assert spot.value == ordered[rank]
        assert spot.below == sum(v < spot.value for v in values)
        assert spot.equal == values.count(spot.value)


def test_ranks_of_large_integers(spark):
    values = [2**60 + i for i in range(200)] + [5, 6]
    found = selection.locate_ranks(one_column(spark, values, "bigint"), F.col("x"), [0, 1, 2, 100, 201], bins=4)
    assert [found[r].value for r in (0, 1, 2, 100, 201)] == [5, 6, 2**60, 2**60 + 98, 2**60 + 199]


def test_rank_outside_the_table(spark):
    with pytest.raises(ValueError):
        selection.locate_ranks(one_column(spark, [1.0]), F.col("x"), [1])


@pytest.mark.parametrize("probabilities", [[0.0, 0.25, 0.5, 0.75, 1.0], [0.1, 0.99]])
def test_quantiles_against_numpy(spark, probabilities):
    values = list(np.random.default_rng(3).exponential(20, 501).round(2))
    got = selection.exact_quantiles(one_column(spark, [float(v) for v in values]), F.col("x"), probabilities)
    assert got == pytest.approx(list(np.quantile(values, probabilities)))


def test_quantiles_of_nothing(spark):
    assert selection.exact_quantiles(one_column(spark, []), F.col("x"), [0.5]) == [None]


BIG = 1.7e308


@pytest.mark.parametrize("values", [[float("inf"), 1.0, 2.0, 3.0], [float("-inf"), float("-inf"), 5.0, float("inf")], [-BIG, BIG, 0.0, 1.0, BIG], [float("nan"), 4.0, 2.0]])
def test_ranks_of_extreme_values(spark, values):
    ordered = sorted(v for v in values if v == v)
    found = selection.locate_ranks(one_column(spark, values), F.col("x"), list(range(len(ordered))))
    assert [found[r].value for r in range(len(ordered))] == ordered


def test_rank_search_ends_with_one_infinity_among_many(spark):
    df = spark.range(30_000).select(F.when(F.col("id") == 7, float("inf")).otherwise(F.rand(3)).alias("x"))
    assert 0.4 < selection.exact_quantiles(df, F.col("x"), [0.5])[0] < 0.6


def test_quantiles_of_several_columns_at_once(spark):
    rows = [(float(i), i * i, None) for i in range(101)]
    df = spark.createDataFrame(rows, "a double, b bigint, c double")
    got = selection.quantiles_of(df, {c: F.col(c) for c in "abc"}, [0.25, 0.5])
    assert got == {"a": [25.0, 50.0], "b": [625.0, 2500.0], "c": [None, None]}


def test_iqr_bounds_of_nothing(spark):
    assert profiling.iqr_bounds(one_column(spark, [None, None]), F.col("x")) == (None, None)


def test_time_blocks_with_missing_totals(spark):
    """Half the rows share a moment, a third have no total: folds are equal and follow the sorted order."""
    start, rng = datetime(2025, 1, 1), random.Random(4)
    rows = []
    for i in range(60):
        ts = start if i % 2 else start + timedelta(minutes=rng.randint(-9, 9))
        rows.append((ts, ts, 1, 2, 1.0, 5.0, None if i % 3 == 0 else float(i), 1.0, 1.0, 1.0, "N"))
    df = spark.createDataFrame(rows, S.TRIP_SCHEMA)
    got = split.with_time_blocks(df, 5).collect()
    place = sorted(rows, key=lambda r: (r[0], r[S.TRIP_COLUMNS.index(S.TOTAL)] is not None, r[S.TRIP_COLUMNS.index(S.TOTAL)] or 0))
    assert all(r.block is not None for r in got)
    totals = sorted((r[S.PICKUP], r[S.TOTAL] is not None, r[S.TOTAL] or 0, r.block) for r in got)
    assert [t[:3] for t in totals] == [(r[0], r[6] is not None, r[6] or 0) for r in place]
    assert [t[3] for t in totals] == sorted(t[3] for t in totals)
    short = split.with_time_blocks(df.drop(S.TOTAL), 5)
    assert "block" in short.columns and short.filter("block is null").count() == 0


def test_iqr_bounds_of_one_to_a_hundred(spark):
    df = one_column(spark, [float(i) for i in range(1, 101)])
    low, high = profiling.iqr_bounds(df, F.col("x"), 1.5)
    assert (low, high) == (-48.5, 149.5)
    wide_low, wide_high = profiling.iqr_bounds(df, F.col("x"), 3.0)
    assert wide_low < low and wide_high > high


def test_iqr_flags_an_outlier(spark):
    low, high = profiling.iqr_bounds(one_column(spark, [1.0, 2.0, 3.0, 4.0, 5.0, 1000.0]), F.col("x"))
    assert high < 1000 and low < 1


def rows_with_ties(spark, n=300, seed=1):
    """Rows where one moment holds more than a third of all, as few as one distinct key apart."""
    rng = random.Random(seed)
    start = datetime(2025, 1, 1)
    rows = []
    for i in range(n):
        ts = start if rng.random() < 0.4 else start + timedelta(seconds=rng.randint(-50, 50), microseconds=rng.randint(0, 5))
        rows.append((ts, rng.randint(0, 3), float(i)))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "ts timestamp_ntz, a int, b double"), rows


@pytest.mark.parametrize("k", [3, 5])
def test_time_blocks_against_sorted_positions(spark, k):
    df, rows = rows_with_ties(spark)
    keys = [selection.SortKey.timestamp("ts"), selection.SortKey.of(F.col("a")), selection.SortKey.of(F.col("b"))]
    got = {r.b: r.block for r in split.with_time_blocks(df, k, keys).collect()}
    size, n = len(rows) // (k + 1), len(rows)
    for position, row in enumerate(sorted(rows)):
        want = 0 if position < n - k * size else 1 + (position - (n - k * size)) // size
        assert got[row[2]] == want


def test_folds_are_disjoint_ordered_and_equal(ws):
    blocks = split.with_time_blocks(ws.train(), 5)
    stats = blocks.groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.min(S.PICKUP).alias("lo"), F.max(S.PICKUP).alias("hi"))
    rows = stats.orderBy("block").collect()
    assert [r.block for r in rows] == list(range(6))
    assert len({r.n for r in rows[1:]}) == 1 and sum(r.n for r in rows) == ws.train().count()
    assert all(a.hi <= b.lo for a, b in zip(rows, rows[1:]))


def test_time_blocks_need_no_shuffle(ws):
    plan = executed_plan(split.with_time_blocks(ws.train(), 5))
    assert "Exchange" not in plan and "Window" not in plan


def test_too_few_rows_for_the_folds():
    with pytest.raises(ValueError):
        split.fold_ranks(3, 5)


def test_cutoff_partitions_the_trips(ws):
    train, test = split.by_cutoff(ws.clean(), "2000-01-01")
    assert train.count() + test.count() == ws.clean().count()
    assert train.agg(F.max(S.PICKUP)).first()[0] < datetime(2000, 1, 1) <= test.agg(F.min(S.PICKUP)).first()[0]


@pytest.mark.parametrize("n", [1, 50, 333])
def test_sample_size_and_determinism(spark, n):
    df = spark.range(500).withColumn("key", F.col("id").cast("string"))
    first = {r.id for r in sampling.sample_rows(df, n, F.col("key")).collect()}
    again = {r.id for r in sampling.sample_rows(df.repartition(3), n, F.col("key")).collect()}
    other = {r.id for r in sampling.sample_rows(df, n, F.col("key"), seed=7).collect()}
    assert len(first) == n and first == again and first != other


def test_sample_of_a_small_table_is_the_table(spark):
    assert sampling.sample_rows(spark.range(5), 10, F.col("id").cast("string")).count() == 5


def test_sample_takes_part_of_a_large_group_of_copies(spark):
    df = spark.range(90).select(F.when(F.col("id") < 60, "same").otherwise(F.col("id").cast("string")).alias("key"))
    for n in (5, 30, 70):
        assert sampling.sample_rows(df, n, F.col("key")).count() == n


def test_histogram_against_numpy(spark):
    values = np.random.default_rng(5).gamma(2.0, 10.0, 400)
    rows = profiling.histogram(one_column(spark, [float(v) for v in values]), F.col("x"), 20).orderBy("bin").collect()
    counts, edges = np.histogram(values, 20)
    assert [r.n for r in rows] == list(counts)
    assert [r.bin_low for r in rows] == pytest.approx(list(edges[:-1]), abs=1e-5)


def test_histogram_skips_nan(spark):
    rows = profiling.histogram(one_column(spark, [1.0, 2.0, float("nan"), 3.0, None]), F.col("x"), 2).orderBy("bin").collect()
    assert [(r.bin_low, r.bin_high, r.n) for r in rows] == [(1.0, 2.0, 1), (2.0, 3.0, 2)]


def test_histogram_of_a_constant_and_of_nothing(spark):
    constant = profiling.histogram(one_column(spark, [3.0] * 4), F.col("x"), 10)
    assert constant.agg(F.sum("n")).first()[0] == 4
    assert profiling.histogram(one_column(spark, []), F.col("x"), 10).agg(F.sum("n")).first()[0] == 0


def test_box_stats_against_pandas(ws):
    got = profiling.box_stats(ws.train(), S.RATE).toPandas().set_index(S.RATE)
    for code, values in ws.train().select(S.RATE, S.TARGET).toPandas().groupby(S.RATE)[S.TARGET]:
        q1, median, q3 = values.quantile([0.25, 0.5, 0.75])
        inside = values[values.between(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))]
        want = [q1, median, q3, min(inside.min(), q1), max(inside.max(), q3)]
        assert list(got.loc[code, ["q1", "median", "q3", "whisker_low", "whisker_high"]]) == pytest.approx(want, abs=1e-5)


def test_describe_against_pandas(ws):
    got = profiling.describe_duration(ws.train()).first()
    want = ws.train().select(S.TARGET).toPandas()[S.TARGET].describe(percentiles=profiling.DESCRIBE_PERCENTILES)
    assert [got[c] for c in ("count", "mean", "std", "min", "p25", "p50", "p75", "p90", "p95", "p99", "max")] == pytest.approx(
        list(want), abs=1e-5
    )


def test_correlation_skips_missing_pairs(spark):
    rows = [(1.0, 2.0), (2.0, None), (3.0, 5.0), (None, 1.0), (4.0, 4.5)]
    got = profiling.correlation_matrix(spark.createDataFrame(rows, "a double, b double"), ["a", "b"]).first().correlation
    assert got == pytest.approx(pd.DataFrame(rows, columns=["a", "b"]).corr().iloc[0, 1])


def test_extremes_prefer_the_smaller_key(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 9.0), (3, 9.0), (4, 5.0)], "k int, v double")
    assert tuple(profiling.extremes(df, "k", "v").first()) == (2, 9.0, 1, 5.0)
