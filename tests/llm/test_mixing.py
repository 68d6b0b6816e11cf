import hashlib
from collections import defaultdict

import pytest

from wayfare.llm import mixing


def plain(rows):
    """Targets by resharing step by step; words taken by walking each source in order of the hash."""
    sizes = [len((r[1] or "").encode().split()) for r in rows]
    by = defaultdict(int)
    for r, n in zip(rows, sizes):
        by[r[3]] += n
    names = sorted(by, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    want, capped = 1.5 * sum(by.values()), set()
    while True:
        left = want - sum(2 * by[s] for s in capped)
        open_ = [s for s in names if s not in capped]
        level = left / sum(weight[s] for s in open_) if open_ else 0
        over = {s for s in open_ if 2 * by[s] <= weight[s] * level}
        if not over:
            break
        capped |= over
    target = {s: 2.0 * by[s] if s in capped else weight[s] * level for s in names}
    return sizes, by, target


def test_against_step_by_step(odd, odd_rows):
    sizes, by, target = plain(odd_rows)
    got = mixing.mix(odd).collect()
    assert len(got) == len(odd_rows)
    source = {r[0]: r[3] for r in odd_rows if r[0] is not None}
    taken = defaultdict(int)
    for r in got:
        name = source[r.doc_id] if r.doc_id is not None else "b"
        assert r.source_size == by[name]
        assert r.target == pytest.approx(target[name])
        assert 0 <= r.taken <= 2 * r["size"]
        taken[name] += r.taken
    for name, total in taken.items():
        assert abs(total - target[name]) <= 2  # rounding down, and repeated ids at a cut


def test_order_is_the_hash(spark):
    rows = [(i, "x " * (i + 1), "s") for i in range(50)] + [(100 + i, "y " * 60, "t") for i in range(9)]
    got = {r.doc_id: r.taken for r in mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    budget = int(mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).filter("doc_id < 100").first().target)
    size = sum(i + 1 for i in range(50))
    epochs, rest = divmod(budget, size)
    for i in sorted(range(50), key=lambda i: hashlib.md5(f"mix|{i}".encode()).hexdigest()):
        more = min(max(rest, 0), i + 1)
        rest -= more
        assert got[i] == epochs * (i + 1) + more


def test_reruns_agree_and_empty(odd, none):
    key = lambda r: (str(r.doc_id), r["size"], r.taken)
    assert sorted(mixing.mix(odd).collect(), key=key) == sorted(mixing.mix(odd.repartition(7)).collect(), key=key)
    assert mixing.mix(none).collect() == [] and mixing.mixed_documents(none).collect() == []


def test_documents_repeat_as_taken(odd):
    got = mixing.mixed_documents(odd)
    assert got.columns == odd.columns
    copies = {}
    for r in got.collect():
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    for r in mixing.mix(odd).collect():
        if r.doc_id is not None and r.doc_id != 18:
            assert abs(copies.get(r.doc_id, 0) * r["size"] - r.taken) <= r["size"] / 2


def test_native_plan(odd):
    plan = mixing.mix(odd)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_the_mix_meets_its_budget_without_ids(spark):
    """Half of the rows have no id and others share one: the budgets are met within one document."""
    rows = [(None if i % 2 else 5, "x " * 20 + str(i), "a" if i % 3 else "b") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    target = {r.source: r.target for r in mixing.plan_mix(mixing.sized(docs)).collect()}
    taken = mixing.mixed_documents(docs).groupBy("source").count().collect()
    assert {r.source: r["count"] * 21 for r in taken} == pytest.approx(target, abs=21)
