import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from wayfare import schema as S
from wayfare.models import boosting, evaluation, linear_search, neural, pipelines, saved, scores, search, store
from wayfare.operators import split
from wayfare.plans import features

COLUMNS = ["a", "b", "twice_a", "constant"]


@pytest.fixture(scope="module")
def data(spark):
    """Four inputs, one a multiple of another and one constant, in four time blocks."""
    rng = np.random.default_rng(11)
    a, b = rng.normal(5, 2, 400), rng.exponential(3, 400)
    y = 3 * a - 2 * b + 10 + rng.normal(0, 1, 400)
    rows = [(float(x), float(z), float(2 * x), 1.0, float(t), int(i // 100)) for i, (x, z, t) in enumerate(zip(a, b, y))]
    return spark.createDataFrame(rows, f"a double, b double, twice_a double, constant double, {S.TARGET} double, block int").cache()


@pytest.fixture(scope="module")
def arrays(data):
    pdf = data.toPandas()
    return pdf[COLUMNS].to_numpy(), pdf[S.TARGET].to_numpy(), pdf["block"].to_numpy()


def ridge_by_hand(x, y, alpha):
    mean, scale = x.mean(0), x.std(0)
    scale[scale == 0] = 1
    z = (x - mean) / scale
    w = np.linalg.solve(z.T @ z + alpha * np.eye(x.shape[1]), z.T @ (y - y.mean()))
    return w / scale, y.mean() - mean @ (w / scale)


def test_moments_add_up(data, arrays):
    x, y, _ = arrays
    parts = list(linear_search.block_moments(data, COLUMNS).values())
    whole = sum(parts[1:], parts[0])
    full = np.column_stack([x, y])
    centred = full - full.mean(0)
    assert whole.rows == 400 and len(parts) == 4
    assert np.allclose(whole.mean, full.mean(0)) and np.allclose(whole.scatter, centred.T @ centred)


@pytest.mark.parametrize("alpha", [0.01, 1.0, 100.0])
def test_ridge_solve_matches_the_normal_equations(data, arrays, alpha):
    x, y, _ = arrays
    parts = list(linear_search.block_moments(data, COLUMNS).values())
    line = linear_search.solve(sum(parts[1:], parts[0]), alpha)
    w, b = ridge_by_hand(x, y, alpha)
    assert np.allclose(line.weights, w) and line.intercept == pytest.approx(b)


@pytest.mark.parametrize("alpha", [0.1, 50.0])
def test_ridge_pipeline_matches_the_normal_equations(data, arrays, alpha):
    x, y, _ = arrays
    model = pipelines.ridge_regression(COLUMNS[:2], alpha, len(y), float(y.std())).fit(data).stages[-1]
    w, b = ridge_by_hand(x[:, :2], y, alpha)
    assert np.allclose(model.coefficients.toArray(), w) and model.intercept == pytest.approx(b)


def test_least_squares_with_collinear_inputs(data, arrays):
    x, y, _ = arrays
    design = np.column_stack([x[:, :2], np.ones(len(y))])
    want = design @ np.linalg.lstsq(design, y, rcond=None)[0]
    fitted = pipelines.linear_regression(COLUMNS).fit(data).transform(data).select("prediction").toPandas().prediction
    assert np.allclose(fitted, want, atol=1e-3)
    parts = list(linear_search.block_moments(data, COLUMNS).values())
    line = linear_search.solve(sum(parts[1:], parts[0]))
    assert np.allclose(x @ line.weights + line.intercept, want)


@pytest.mark.parametrize("alpha", [0.0, 10.0])
def test_fold_scores_match_fits_per_fold(data, arrays, alpha):
    x, y, block = arrays
    moments = linear_search.block_moments(data, COLUMNS)
    got = {r.block: r for r in linear_search.fold_metrics(data, COLUMNS, moments, alpha).collect()}
    unclipped = []
    for held in (1, 2, 3):
        past, now = block < held, block == held
        if alpha:
            w, b = ridge_by_hand(x[past], y[past], alpha)
            p = x[now] @ w + b
        else:
            design = np.column_stack([x[:, :2], np.ones(len(y))])
            p = design[now] @ np.linalg.lstsq(design[past], y[past], rcond=None)[0]
        unclipped.append(np.sqrt(np.mean((y[now] - p) ** 2)))
        p = np.clip(p, 0, None)
        assert got[held].RMSE == pytest.approx(np.sqrt(np.mean((y[now] - p) ** 2)))
        assert got[held].MAE == pytest.approx(np.mean(np.abs(y[now] - p)))
    assert linear_search.grid_scores(moments, [alpha])[0][1] == pytest.approx(np.mean(unclipped))


def test_first_of_equal_penalties_wins():
    assert linear_search.best_alpha([(0.1, 2.0), (1.0, 1.5), (10.0, 1.5)]) == 1.0


def test_generic_validation_agrees_with_moments(data):
    moments = linear_search.block_moments(data, COLUMNS[:2])
    quick = {r.block: r.RMSE for r in linear_search.fold_metrics(data, COLUMNS[:2], moments).collect()}
    folds = search.cross_validate(data, pipelines.linear_regression(COLUMNS[:2]), "ols").collect()
    assert {r.block: r.RMSE for r in folds} == pytest.approx(quick)


def test_draws_are_distinct_and_repeatable(spark):
    space = {"x": [1, 2, 3], "y": ["p", "q"]}
    picked = search.draws(spark, space, 4)
    assert picked == search.draws(spark, space, 4) and len({tuple(d.items()) for d in picked}) == 4
    everything = search.draws(spark, space, 99)
    assert len(everything) == 6 and sorted(map(str, everything)) == sorted(map(str, search.grid(space)))
    assert search.draws(spark, space, 6, seed=1) != everything
    found = search.points(spark, pipelines.BOOSTING_SPACE, pipelines.SEARCH_DRAWS).collect()
    assert len({r.number for r in found}) == 30 and max(r.number for r in found) < 82_944
    assert [r.draw for r in sorted(found, key=lambda r: r.draw)] == list(range(30))


def test_settings_of_a_draw():
    draw = dict(num_leaves=127, learning_rate=0.1, n_estimators=200, max_depth=-1, min_child_samples=20, subsample=0.7, colsample_bytree=1.0, reg_alpha=0.5, reg_lambda=0.1)
    found = boosting.settings_of(draw)
    assert found.depth == 7 and found.l1 == 0.5 and found.l2 == 0.1 and found.rounds == 200 and found.patience is None
    assert boosting.settings_of({**draw, "max_depth": 6}).depth == 6 and boosting.settings_of({**draw, "num_leaves": 255}).depth == 8


def test_search_orders_candidates(data):
    candidates = [
        ("stump", pipelines.boosted_trees(COLUMNS, maxIter=1, maxDepth=1)),
        ("linear", pipelines.linear_regression(COLUMNS[:2])),
    ]
    rows = search.search(data, candidates).collect()
    assert [r.model for r in rows] == ["linear", "stump"] and rows[0].folds == 3


def test_library_trees_stop_early(spark, data, tmp_path):
    marked = pipelines.with_validation_block(data)
    assert {r.block for r in marked.filter("is_validation").select("block").distinct().collect()} == {3}
    model = pipelines.boosted_trees(COLUMNS, validation="is_validation", maxIter=30, maxDepth=3, stepSize=0.3).fit(marked)
    assert 1 <= model.stages[-1].getNumTrees <= 30
    store.save_model(model, str(tmp_path), "trees")
    loaded = store.load_model(spark, str(tmp_path), "trees")
    same = model.transform(data).select("prediction").exceptAll(loaded.transform(data).select("prediction"))
    assert same.isEmpty() and store.input_columns(loaded) == COLUMNS


def test_saved_models_are_measured_together_and_missing_ones_skipped(spark, data, tmp_path):
    test = data.withColumn("baseline_duration", F.lit(1.0))
    store.save_model(pipelines.linear_regression(COLUMNS[:2]).fit(data), str(tmp_path), "linear")
    stump = pipelines.boosted_trees(COLUMNS, maxIter=1, maxDepth=1).fit(data)
    store.save_model(stump, str(tmp_path), "stump")
    together = evaluation.evaluate_saved(test, str(tmp_path), ["linear", "absent", "stump"])
    rows = {r.model: r for r in together.collect()}
    assert set(rows) == {"baseline", "linear", "stump"}
    assert rows["stump"] == evaluation.evaluate_fitted(data, {"stump": stump}, baseline=False).first()
    assert rows["linear"].RMSE < rows["stump"].RMSE < rows["baseline"].RMSE


def test_missing_model_is_none(spark, tmp_path):
    assert store.load_model(spark, str(tmp_path), "nothing") is None


def test_scaling(data):
    scaled = pipelines.scaled_features(COLUMNS).fit(data).transform(data)
    values = np.array([r[0] for r in scaled.select(vector_to_array("scaled")).collect()])
    assert np.allclose(values.mean(0), 0) and np.allclose(values[:, :3].std(0, ddof=1), 1)


def test_saved_neural_bands_predict_the_same(spark, data, tmp_path):
    model = neural.fit_bands(data, COLUMNS[:2], bands=3, hidden=[4], max_iter=20)
    store.save_model(model, str(tmp_path), "bands")
    loaded = store.load_model(spark, str(tmp_path), "bands")
    assert store.input_columns(loaded) == COLUMNS[:2]
    both = evaluation.with_predictions(data, {"saved": model, "loaded": loaded})
    assert both.filter("abs(saved - loaded) > 1e-9").count() == 0
    assert store.load_model(spark, str(tmp_path), "nothing") is None


def test_neural_parts_go_on_after_a_cut(spark, data, tmp_path, monkeypatch):
    data = data.coalesce(1)  # one task, so that sums of gradients have one order
    whole = neural.fit_bands(data, COLUMNS[:2], bands=3, hidden=[4], max_iter=25, part=10, root=f"{tmp_path}/whole")
    fits, fit = [], neural.MultilayerPerceptronClassifier.fit

    def cut(self, df):
        if len(fits) == 2:
            raise RuntimeError("lost")
        fits.append(1)
        return fit(self, df)

    monkeypatch.setattr(neural.MultilayerPerceptronClassifier, "fit", cut)
    with pytest.raises(RuntimeError):
        neural.fit_bands(data, COLUMNS[:2], bands=3, hidden=[4], max_iter=25, part=10, root=f"{tmp_path}/cut")
    fits[:] = [1]  # one more fit is allowed: the parts before are not fitted again
    again = neural.fit_bands(data, COLUMNS[:2], bands=3, hidden=[4], max_iter=25, part=10, root=f"{tmp_path}/cut")
    both = evaluation.with_predictions(data, {"whole": whole, "again": again})
    assert both.filter("abs(whole - again) > 1e-6").isEmpty()


def test_neural_validation_has_three_folds(spark, ws):
    train = split.with_time_blocks(ws.train(), 3).select(S.DISTANCE, S.PASSENGERS, S.TARGET, "block").limit(10_000)
    train.write.mode("overwrite").parquet(ws.path("neural_folds"))
    stored = spark.read.parquet(ws.path("neural_folds"))
    columns = [S.DISTANCE, S.PASSENGERS]
    folds = search.cross_validate(stored, lambda past: neural.fit_bands(past, columns, bands=3, hidden=[4], max_iter=5), "neural").collect()
    assert sorted(r.block for r in folds) == [1, 2, 3]


def test_neural_bands_predict_inside_the_label_range(data):
    model = neural.fit_bands(data, COLUMNS[:2], bands=4, hidden=[8], max_iter=60)
    scored = model.transform(data)
    error = scored.agg(F.avg(F.abs(F.col("prediction") - F.col(S.TARGET)))).first()[0]
    spread = scored.agg(F.stddev(S.TARGET)).first()[0]
    assert error < spread
    assert min(model.band_means) <= scored.agg(F.min("prediction")).first()[0]


def test_training_on_staged_features_beats_nothing(ws):
    train = ws.train_matrix()
    model = pipelines.linear_regression(features.FULL_FEATURES).fit(train)
    assert model.stages[-1].summary.r2 > 0


# ---- boosting by rounds

SMALL = boosting.Settings(rounds=6, rate=0.4, depth=2, min_rows=5, row_share=0.7, column_share=0.5, l1=1.0, l2=2.0, patience=None, bins=32, part=2)


def best_cut(x, r, least):
    """Column, threshold and gain of the best split, by trying all."""
    found = (0.0, None, None)
    for j in range(x.shape[1]):
        values = np.unique(x[:, j])
        for low, high in zip(values, values[1:]):
            left = x[:, j] <= (low + high) / 2
            if min(left.sum(), (~left).sum()) >= least:
                gain = r[left].sum() ** 2 / left.sum() + r[~left].sum() ** 2 / (~left).sum() - r.sum() ** 2 / len(r)
                if gain > found[0] + 1e-9:
                    found = (gain, j, (low + high) / 2)
    return found


@pytest.fixture(scope="module")
def coarse(spark):
    """Two inputs of few values and a target, in three blocks of 100."""
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.integers(0, 6, 300), rng.integers(0, 4, 300)]).astype(float)
    y = 3.0 * (x[:, 0] > 2) - 2 * x[:, 1] + x[:, 0] * (x[:, 1] > 1) + rng.normal(0, 2, 300) + 10
    rows = [(*map(float, v), float(t), i // 100) for i, (v, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, f"a double, b double, {S.TARGET} double, block int").repartition(3).cache(), x, y


def grown_by_hand(x, y, held, settings):
    """Predictions and held-out errors of stumps grown by trying every split."""
    f, errors = np.full(len(y), y[~held].mean()), []
    for _ in range(settings.rounds):
        r = y - f
        _, j, cut = best_cut(x[~held], r[~held], settings.min_rows)
        left = x[:, j] <= cut
        for side in (left, ~left):
            total, n = r[side & ~held].sum(), (side & ~held).sum()
            f[side] += settings.rate * np.sign(total) * max(abs(total) - settings.l1, 0) / (n + settings.l2)
        errors.append(np.mean((y[held] - f[held]) ** 2) if held.any() else np.nan)
    return f, errors


@pytest.mark.parametrize("l1, l2", [(0.0, 0.0), (6.0, 9.0)])
def test_stumps_with_penalties_equal_the_hand_grown(coarse, l1, l2):
    df, x, y = coarse
    settings = boosting.Settings(rounds=3, rate=0.5, depth=1, min_rows=20, row_share=1, column_share=1, l1=l1, l2=l2, patience=None, bins=32)
    model = boosting.fit(df, ["a", "b"], settings)
    want, _ = grown_by_hand(x, y, np.zeros(len(y), bool), settings)
    got = {(r.a, r.b): r.prediction for r in model.transform(df).collect()}
    assert all(got[a, b] == pytest.approx(p) for (a, b), p in zip(x.tolist(), want))
    assert model.kept == 3


def test_patience_keeps_the_rounds_of_the_whole_curve(coarse, spark):
    df, x, y = coarse
    held = np.repeat([False, False, True], 100)
    settings = boosting.Settings(rounds=40, rate=0.9, depth=1, min_rows=5, row_share=1, column_share=1, l1=0, l2=0, patience=3, bins=32)
    _, errors = grown_by_hand(x, y, held, settings)
    keep, over = boosting.best_round(errors, 3)
    model = boosting.fit(df, ["a", "b"], settings)
    assert over and model.kept == keep < 40
    assert model.errors == pytest.approx(errors[: len(model.errors)]) and len(model.errors) == keep + 3
    curve = boosting.error_curve(model, spark).collect()
    assert [r.kept for r in curve] == [i < keep for i in range(keep + 3)]
    # the curve is measured, not only added up
    rest = model.transform(df.filter("block = 2")).agg(F.avg((F.col(S.TARGET) - F.col("prediction")) ** 2)).first()[0]
    assert rest == pytest.approx(errors[keep - 1])


def test_best_round_has_patience():
    assert boosting.best_round([5.0, 4.0, 4.5, 4.2, 3.0, 3.5], 3) == (5, False)
    assert boosting.best_round([5.0, 4.0, 4.5, 4.2, 4.1, 3.0], 3) == (2, True)
    assert boosting.best_round([1.0], 50) == (1, False)
    assert boosting.best_round([], 50) == (0, False)
    assert boosting.best_round([2.0, 3.0], None) == (2, False)


def test_a_cut_fit_goes_on_and_ends_the_same(coarse, tmp_path, monkeypatch, spark):
    df, _, _ = coarse
    whole = boosting.fit(df, ["a", "b"], SMALL, f"{tmp_path}/whole")
    grown, grow = [], boosting._grown

    def cut(*args):
        if len(grown) == 3:
            raise RuntimeError("lost")
        grown.append(args[-1])
        return grow(*args)

    monkeypatch.setattr(boosting, "_grown", cut)
    with pytest.raises(RuntimeError):
        boosting.fit(df, ["a", "b"], SMALL, f"{tmp_path}/cut")
    monkeypatch.setattr(boosting, "_grown", lambda *args: grown.append(args[-1]) or grow(*args))
    again = boosting.fit(df, ["a", "b"], SMALL, f"{tmp_path}/cut")
    assert grown == [*range(3), *range(2, 6)]  # the whole part of two is not grown again
    both = whole.transform(df).select("a", "b", F.col("prediction").alias("p")).distinct().join(again.transform(df).distinct(), ["a", "b"])
    assert both.filter("abs(p - prediction) > 1e-12").isEmpty()
    done = boosting.fit(df, ["a", "b"], SMALL, f"{tmp_path}/cut")
    assert len(done.rounds) == 6 and len(grown) == 7
    loaded = boosting.load(spark, f"{tmp_path}/cut", whole.base, SMALL)
    assert loaded.kept == 6
    with pytest.raises(ValueError, match="other settings"):
        boosting.fit(df, ["a"], SMALL, f"{tmp_path}/cut")


def test_rounds_draw_rows_and_columns(coarse):
    df, _, _ = coarse
    drawn = [boosting.chosen_columns(list("abcdefghij"), SMALL, at) for at in range(6)]
    assert all(len(d) == 5 and d == sorted(d) for d in drawn) and len({tuple(d) for d in drawn}) > 2
    keyed = df.withColumn(boosting.ROW, F.monotonically_increasing_id())
    kept = [keyed.filter(boosting.in_sample(SMALL, at)).count() for at in range(3)]
    assert all(160 < n < 260 for n in kept) and len(set(kept)) > 1


@pytest.mark.parametrize("depth, least, patience", [(2, 5, 3), (1, "edge", 3), (2, 150, 2)])
def test_rows_of_equal_inputs_are_summed_up_once(coarse, spark, monkeypatch, tmp_path, depth, least, patience):
    """The same trees, values and errors as grown on rows, from no more rows than there are inputs in either part."""
    df, x, _ = coarse
    if least == "edge":  # as many rows as the smaller side of a split has
        left = int((x[:200, 0] <= 2).sum())
        least = min(left, 200 - left)
    settings = boosting.Settings(rounds=3, rate=0.6, depth=depth, min_rows=least, row_share=1, column_share=1, l1=2.0, l2=3.0, patience=patience, bins=32)
    grow, met = boosting._grown, []
    monkeypatch.setattr(boosting, "_grown", lambda current, *args: met.append(current.count()) or grow(current, *args))
    found = {}
    for name, alike, table in (("rows", math.inf, df), ("sums", boosting.ALIKE, df), ("more", boosting.ALIKE, df.unionAll(df))):
        monkeypatch.setattr(boosting, "ALIKE", alike)
        met.clear()
        change = {"min_rows": 2 * least, "l1": 4.0, "l2": 6.0} if name == "more" else {}
        model = boosting.fit(table, ["a", "b"], replace(settings, **change), f"{tmp_path}/{name}")
        nodes = saved.nodes(spark, boosting.part_folders(f"{tmp_path}/{name}")).orderBy("stage", "node").collect()
        scale = 2 if name == "more" else 1
        splits = [(r.stage, r.node, r.feature, r.threshold, r.rows / scale) for r in nodes]
        numbers = [r.gain / scale for r in nodes] + [v for one in model.rounds for v in one.values] + [model.base]
        found[name] = splits, model.kept, numbers + ([] if patience is None else model.errors)
        assert max(met) == 300 if name == "rows" else max(met) <= 2 * len(np.unique(x, axis=0))
    splits, kept, numbers = found["rows"]
    assert bool(splits) == (least <= 100)
    for name in ("sums", "more"):
        assert found[name][:2] == (splits, kept) and found[name][2] == pytest.approx(numbers)


def test_sampled_rounds_and_many_inputs_run_on_rows(data, coarse, monkeypatch):
    grow, met = boosting._grown, []
    monkeypatch.setattr(boosting, "_grown", lambda current, *args: met.append(boosting.ROWS in current.columns) or grow(current, *args))
    boosting.fit(coarse[0], ["a", "b"], replace(SMALL, rounds=1))
    boosting.fit(data, ["a", "b"], replace(SMALL, rounds=1, row_share=1.0))
    boosting.fit(coarse[0], ["a", "b"], replace(SMALL, rounds=1, row_share=1.0))
    assert met == [False, False, True]


def test_summed_rows_keep_missing_inputs_an_error(spark):
    rows = [(float(i % 3) if i % 7 else None, float(i), 0) for i in range(200)]
    df = spark.createDataFrame(rows, f"a double, {S.TARGET} double, block int")
    with pytest.raises(Exception, match="null"):
        boosting.fit(df, ["a"], replace(SMALL, rounds=1, row_share=1.0))


def test_nothing_to_grow_on(spark):
    empty = spark.createDataFrame([], f"a double, {S.TARGET} double, block int")
    assert boosting.fit(empty, ["a"], SMALL).kept == 0
    unlabelled = spark.createDataFrame([(1.0, None, 0)], empty.schema)
    assert boosting.fit(unlabelled, ["a"], SMALL).kept == 0


def test_importance_of_saved_trees(coarse, spark, tmp_path):
    df, x, y = coarse
    settings = boosting.Settings(rounds=2, rate=1.0, depth=1, min_rows=5, row_share=1, column_share=1, l1=0, l2=0, patience=None, bins=32)
    boosting.fit(df, ["a", "b"], settings, str(tmp_path))
    r, gains = y - y.mean(), {}
    for _ in range(2):
        gain, j, cut = best_cut(x, r, 5)
        gains.setdefault("ab"[j], []).append(gain)
        left = x[:, j] <= cut
        r = r - np.where(left, r[left].mean(), r[~left].mean())
    got = {r.feature: r for r in saved.importance(spark, boosting.part_folders(str(tmp_path))).collect()}
    assert {f: (r.splits, pytest.approx(r.gain)) for f, r in got.items()} == {f: (len(g), sum(g)) for f, g in gains.items()}
    assert sum(r.importance for r in got.values()) == pytest.approx(1)
    top = saved.top_importance(spark, boosting.part_folders(str(tmp_path)), 1).first()
    assert top.gain == max(r.gain for r in got.values())


def test_a_cut_search_ends_with_the_same_board(data, tmp_path):
    fits = []

    def candidate(depth):
        def fit(past, root):
            if len(fits) == stop_at:
                raise RuntimeError("lost")
            fits.append((depth, past.count()))
            return boosting.fit(past, COLUMNS[:2], boosting.Settings(rounds=1, depth=depth, rate=1.0, min_rows=5, row_share=1, column_share=1, patience=None, bins=32), root)

        return fit

    candidates = [("one", candidate(1)), ("two", candidate(2)), ("linear", pipelines.linear_regression(COLUMNS[:2]))]
    stop_at = 99
    whole = search.search(data, candidates, 1, ledger=f"{tmp_path}/whole").collect()
    assert [r.model for r in whole][0] == "linear" and len(fits) == 6
    fits.clear()
    stop_at = 4
    with pytest.raises(RuntimeError):
        search.search(data, candidates, 1, ledger=f"{tmp_path}/cut")
    stop_at = 99
    assert search.search(data, candidates, 1, ledger=f"{tmp_path}/cut").collect() == whole
    assert len(fits) == 6  # four before the cut, two after
    assert search.search(data, candidates, 1, ledger=f"{tmp_path}/cut").collect() == whole and len(fits) == 6


def test_score_document_round_trip(spark, tmp_path):
    rows = [(m, 0.1 * i + b, 2.0, 0.5) for i, m in enumerate(scores.FAMILIES) for b in range(3)]
    folds = spark.createDataFrame(rows, "model string, RMSE double, MAE double, R2 double")
    summary = scores.summary(folds)
    params = {"n_estimators": 200, "learning_rate": 0.05}
    scores.write(summary, f"{tmp_path}/all", 10.0, params)
    read = scores.read(spark, f"{tmp_path}/all")
    one = read.first()
    assert one.boosted_trees.best_params == {"n_estimators": "200", "learning_rate": "0.05"} and one.ridge_regression.best_alpha == 10.0
    assert [c for c in read.columns] == scores.FAMILIES
    got = {r.model: r for r in scores.listed(read).collect()}
    want = {r.model: r for r in summary.collect()}
    assert set(got) == set(scores.FAMILIES)
    assert all(got[m][c] == want[m][c] for m in want for c in ["folds", *scores.MEASURES])
    scores.write(summary.filter("model = 'baseline'"), f"{tmp_path}/one")
    alone = scores.listed(scores.read(spark, f"{tmp_path}/one")).collect()
    assert [r.model for r in alone] == ["baseline"] and alone[0].best_params is None


def test_saved_scaling_and_inputs(spark, data, tmp_path):
    store.save_model(pipelines.linear_regression(COLUMNS).fit(data), str(tmp_path), "line")
    listed = saved.inputs(spark, f"{tmp_path}/line").orderBy("position").collect()
    assert [r.feature for r in listed] == COLUMNS and {r.stage for r in listed} == {0}
    scaling = saved.scaling(spark, f"{tmp_path}/line").orderBy("position").collect()
    want = data.agg(*[f(c) for c in COLUMNS for f in (F.mean, F.stddev_samp)]).first()
    assert [v for r in scaling for v in (r["mean"], r["std"])] == pytest.approx(list(want))


def test_block_moments_send_one_matrix_a_block_and_task(spark):
    rows = spark.range(900).select(
        (F.col("id") % 3).cast("int").alias("block"), F.rand(1).alias("a"), F.lit(4.0).alias("constant"), F.rand(2).alias("y")
    )
    frame = rows.toPandas()
    moments = linear_search.block_moments(rows.repartition(5), ["a", "constant"], "y")
    assert list(moments) == [0, 1, 2]  # in their order, whatever task ends first
    for block, found in moments.items():
        x = frame[frame.block == block][["a", "constant", "y"]].to_numpy()
        np.testing.assert_allclose(found.scatter, (x - x.mean(0)).T @ (x - x.mean(0)), atol=1e-9)
    with pytest.raises(Exception):
        linear_search.block_moments(rows.withColumn("a", F.when(F.col("a") < 0.5, F.col("a"))), ["a", "constant"], "y")
