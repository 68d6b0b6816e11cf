"""Whitening and hard negatives against plain versions, on vectors with nulls, ties, repeats and odd lengths."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayfare.llm import hardnegatives, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x string, key long, score int, place int"


def vectors(n=240, d=6, seed=3):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(0, 1, d)], int(rng.integers(0, 4))) for i in range(n)]
    rows += [
        (300, None, 1),
        (301, [0.5] * (d - 1) + [None], 1),
        (302, [0.5] * (d - 1) + [float("nan")], 2),
        (303, [0.5] * (d - 1) + [float("inf")], 2),
        (304, [0.25] * d, None),
        (350, rows[50][1], rows[50][2]),  # an anchor with the vector of another
        (50, rows[50][1], rows[50][2]),  # an anchor twice
        (None, rows[9][1], rows[9][2]),
        (None, rows[0][1], 3),
        *[(400 + i, rows[7][1], 2) for i in range(9)],  # ties
    ]
    return [(*r, "clash", 1, 2, 3) for r in rows]


@pytest.fixture(scope="module")
def embedded(spark):
    return spark.createDataFrame(vectors(), SCHEMA).repartition(5).cache()


def usable(rows):
    return [r for r in rows if r[1] is not None and all(c is not None and np.isfinite(c) for c in r[1])]


def mined_plainly(rows):
    last = np.iinfo(np.int64).max
    taken = []
    for vec_id, vector, label, *_ in usable(rows):
        if label is not None:
            moved = (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label
            taken.append((vec_id, moved, np.floor(256 * np.array(vector)).astype(int)))
    answers = []
    for a, label, x in taken:
        if a is None or a % 50:
            continue
        scored = [(-int(x @ y), i if i is not None else last, other) for i, other, y in taken if len(x) == len(y)]
        best = sorted(s for s in scored if s[2] == label and s[1] != a)[:5]
        for minus, positive, _ in best:
            s = -minus
            window = sorted(t for t in scored if t[2] != label and 50 * s <= 100 * -t[0] <= 95 * s)[:3]
            answers += [(a, positive, k + 1, t[1], s, -t[0]) for k, t in enumerate(window)]
    return sorted(tuple(None if v == last else v for v in row) for row in answers) if not any(last in r for r in answers) else sorted(answers)


def mined(spark, df, tmp_path):
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    return hardnegatives.op12_hard_negatives(spark, str(tmp_path))


def test_negatives_equal_the_plain_search(spark, embedded, tmp_path):
    got = [tuple(r) for r in mined(spark, embedded, tmp_path).collect()]
    last = np.iinfo(np.int64).max
    assert len(got) > 50
    assert sorted(tuple(last if v is None else v for v in r) for r in got) == mined_plainly(vectors())


def test_small_blocks_change_nothing(spark, embedded, tmp_path, monkeypatch):
    monkeypatch.setattr(hardnegatives, "ROW_BYTES", 8 * 6 * 20)
    monkeypatch.setattr(hardnegatives, "ANCHOR_BYTES", 8 * 6 * 2)
    monkeypatch.setattr(hardnegatives, "UNIT", 2)
    last = np.iinfo(np.int64).max
    got = [tuple(last if v is None else v for v in r) for r in mined(spark, embedded, tmp_path).collect()]
    assert sorted(got) == mined_plainly(vectors())


def test_other_lengths_do_not_meet(spark, tmp_path):
    rows = [(50 * i, [1.0] * (2 + i % 2), i % 4) for i in range(16)] + [(7 * i + 1, [0.5] * (2 + i % 3), i % 4) for i in range(40)]
    rows = [(*r, "c", 0, 0, 0) for r in rows]
    got = mined(spark, spark.createDataFrame(rows, SCHEMA), tmp_path).collect()
    assert sorted(map(tuple, got)) == mined_plainly(rows)


def test_no_vectors_no_negatives(spark, tmp_path):
    assert mined(spark, spark.createDataFrame([], SCHEMA), tmp_path).count() == 0


def test_one_label_has_no_negatives(spark, tmp_path):
    rows = [(i, [1.0, 2.0], 1, "c", 0, 0, 0) for i in range(1, 120, 2)] + [(100, [1.0, 2.0], 1, "c", 0, 0, 0)]
    assert mined(spark, spark.createDataFrame(rows, SCHEMA).filter("vec_id % 7 != 0"), tmp_path).count() == 0


@pytest.mark.parametrize("largest", [1000, 2**28, 2**31])
def test_scores_and_choice_are_exact(largest):
    rng = np.random.default_rng(0)
    a, b = rng.integers(-largest, largest, (7, 3)), rng.integers(-largest, largest, (40, 3))
    b[10:20] = b[3]
    if 3 * largest**2 >= 2**62:
        with pytest.raises(ValueError):
            hardnegatives.exact_scores(a, b)
        return
    scores = hardnegatives.exact_scores(a, b)
    assert scores.tolist() == [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]
    wanted = rng.random(scores.shape) < 0.6
    found = {(int(i), int(j)) for i, j in zip(*hardnegatives.best(scores, wanted, 4))}
    assert found == {(i, j) for i in range(7) for j in sorted(np.flatnonzero(wanted[i]).tolist(), key=lambda j: (-scores[i, j], j))[:4]}


# ---- whitening


def matrices():
    rng = np.random.default_rng(1)
    full, turn = np.linalg.qr(rng.standard_normal((200, 24)))[0], np.linalg.qr(rng.standard_normal((24, 24)))[0]
    loose = rng.standard_normal((200, 24))
    poor = loose.copy()
    poor[:, 3], poor[:, 7] = 0, poor[:, 8]
    signs = np.abs(np.arange(-10, 11)).astype(float)
    return {
        "random": loose,
        "graded": loose * np.logspace(0, -7, 24),
        "equal": full,
        "clusters": (full * np.repeat([5, 3, 3, 1], 6)) @ turn,
        "nearly equal": (full * (1 + 1e-9 * np.arange(24))) @ turn,
        "poor": poor,
        "few rows": loose[:9],
        "diagonal": np.diag(np.arange(1, 25.0)),
        "identity": np.eye(24),
        "zero": np.zeros((3, 24)),
        "one column": loose[:, :1],
        "close pairs": np.linalg.cholesky(np.diag(signs + 20) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)).T,
    }


@pytest.mark.parametrize("name", list(matrices()))
def test_singular_pairs(name):
    a = matrices()[name]
    d = a.shape[1]
    triangle = np.linalg.qr(a, mode="r")
    squares, v = whitening.singular_pairs(np.concatenate([triangle, np.zeros((d - len(triangle), d))]), d)
    want = np.concatenate([np.linalg.svd(a, compute_uv=False), np.zeros(max(0, d - len(a)))])[:d] ** 2
    scale = max(want[0], 1e-300)
    assert np.abs(squares - want).max() <= 1e-13 * scale
    assert np.abs(v.T @ v - np.eye(d)).max() < 1e-11
    assert np.abs(a.T @ (a @ v) - v * squares).max() <= 1e-11 * scale


def test_small_singular_values_are_as_accurate():
    diagonal, off = np.logspace(0, -12, 20), np.logspace(-1, -13, 19)
    squares = whitening.singular_squares(diagonal, off)
    # every product and quotient is of positive numbers, so scaling each row by a power of two scales nothing else
    exact = whitening.singular_squares(diagonal * 2.0**200, off * 2.0**200) / 2.0**400
    assert np.abs(squares / exact - 1).max() < 1e-13
    assert np.prod(squares) == pytest.approx(float(np.prod(diagonal**2)), rel=1e-12)


def plain_whitening(rows):
    taken = [r for r in usable(rows)]
    x = np.array([np.floor(64 * np.array(r[1])).astype(int) + 1_000_000 for r in taken])
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums // n - (sums % n) / n
    e, v = np.linalg.eigh(centred.T @ centred / n)
    return taken, n, ((n * x - sums) ** 2).sum(axis=1), centred, e[::-1], v[:, ::-1]


def whitened(spark, df, tmp_path):
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    return whitening.op11_whitening(spark, str(tmp_path)).collect()


def test_whitening_equals_the_plain_eigenvectors(spark, embedded, tmp_path):
    got = whitened(spark, embedded, tmp_path)
    taken, n, deviation, centred, e, v = plain_whitening(vectors())
    assert len(got) == len(taken) * 6 and {r.n for r in got} == {n}
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.component), []).append(r)
        assert r.identity_error < 1e-9
        assert r.explained == pytest.approx(e[r.component - 1] / e.sum(), rel=1e-9)
    signs = {}
    for i, row in enumerate(taken):
        for k in range(6):
            want = centred[i] @ v[:, k] / np.sqrt(e[k])
            match = [r for r in by[row[0], k + 1] if abs(abs(r.whitened) - abs(want)) < 1e-8 and r.deviation == deviation[i]]
            assert match
            if abs(want) > 0.01:
                signs.setdefault(k, set()).add(bool(match[0].whitened * want > 0))
    assert all(len(s) == 1 for s in signs.values())


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(5)]])
def test_nothing_to_whiten(spark, tmp_path, rows):
    assert whitened(spark, spark.createDataFrame([(*r, 1, "c", 0, 0, 0) for r in rows], SCHEMA), tmp_path) == []


def test_directions_without_variance_are_left_out(spark, tmp_path):
    rng = np.random.default_rng(0)
    rows = [(i, [float(a), 2.0, float(b), float(a)], 1, "c", 0, 0, 0) for i, (a, b) in enumerate(rng.integers(-9, 9, (60, 2)))]
    got = whitened(spark, spark.createDataFrame(rows, SCHEMA).repartition(7), tmp_path)
    assert {r.component for r in got} == {1, 2} and max(r.identity_error for r in got) < 1e-9


def test_usual_length_only(spark, tmp_path):
    rows = [(i, [float(i % 5), float(i % 3)], 1, "c", 0, 0, 0) for i in range(30)] + [(90, [1.0], 1, "c", 0, 0, 0), (91, [], 1, "c", 0, 0, 0)]
    got = whitened(spark, spark.createDataFrame(rows, SCHEMA), tmp_path)
    assert {r.vec_id for r in got} == set(range(30)) and got[0].n == 30


def test_deviations_beyond_64_bits_are_null():
    centre = whitening.Centre(10**9, [5 * 10**8])
    assert centre.deviations(np.array([[1], [10**6]])) == [(10**9 - 5 * 10**8) ** 2, None]


def test_triangles_meet_in_a_tree(spark, embedded, monkeypatch):
    monkeypatch.setattr(whitening, "GROUP_BYTES", 8 * 36 * 2)
    rows = embedded.filter(hardnegatives.is_usable(F.col("embedding"))).select("vec_id", hardnegatives.whole(F.col("embedding"), 64).alias("x"))
    whole, split = whitening.fit(rows.coalesce(1)), whitening.fit(rows.repartition(9))
    assert np.allclose(whole.eigenvalues, split.eigenvalues, rtol=1e-12)
    assert np.allclose(np.abs(whole.vectors), np.abs(split.vectors), atol=1e-9)
