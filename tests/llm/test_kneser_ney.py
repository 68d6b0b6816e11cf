import collections
import math
import zlib

import pytest

from wayfare.llm import kneser_ney


def model(texts, learn):
    tokens = [[w.decode() for w in (t or "").encode().lower().split()] + ["</s>"] for t in texts]
    words, pairs = collections.Counter(), collections.Counter()
    for t, use in zip(tokens, learn):
        if use:
            words.update(t)
            pairs.update(zip(["<s>", *t], t))
    before = collections.Counter(w for _, w in pairs)
    after, classes = collections.Counter(), collections.defaultdict(lambda: [0, 0, 0])
    for (v, _), n in pairs.items():
        after[v] += n
        classes[v][min(n, 3) - 1] += 1
    of = lambda c: kneser_ney.discounts(*[sum(n == k for n in c.values()) for k in (1, 2, 3, 4)])
    d2, d1 = of(pairs), of(before)
    cut = lambda n, d: d[min(n, 3) - 1] if n else 0.0
    total, types = sum(words.values()), len(words)
    even = sum(cut(n, d1) for n in before.values()) / len(pairs) / (types + 1)
    alone = lambda w: (before[w] - cut(before[w], d1)) / len(pairs) + even

    def p(v, w):
        if not after[v]:
            return alone(w)
        spare = sum(n * d for n, d in zip(classes[v], d2)) / after[v]
        return (pairs[v, w] - cut(pairs[v, w], d2)) / after[v] + spare * alone(w)

    base = [sum(math.log10((words[w] + 1) / (total + types + 1)) for w in t) for t in tokens]
    score = [sum(math.log10(p(v, w)) for v, w in zip(["<s>", *t], t)) for t in tokens]
    known = [sum(words[w] > 0 for w in t) for t in tokens]
    return [(len(t), k, total, b, s) for t, k, b, s in zip(tokens, known, base, score)], sum(p("w1", w) for w in words) + p("w1", "?")


def test_against_plain_model(odd, odd_rows):
    held = [zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 7 == 2 for r in odd_rows]
    expected, mass = model([r[1] for r in odd_rows], [not h for h in held])
    assert mass == pytest.approx(1)
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    want = sorted([(r[0], h, *e) for r, h, e in zip(odd_rows, held, expected)], key=key)
    columns = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got = sorted([tuple(r) for r in kneser_ney.lm_scores(odd).select(*columns).collect()], key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], abs=1e-9)


def test_empty_and_untrained(spark, none):
    assert kneser_ney.lm_scores(none).collect() == []
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    row = kneser_ney.lm_scores(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0) and row.score == row.base_score == 0.0


def test_learning_helps_unseen_texts(spark, sf_dir):
    found = kneser_ney.op1_kneser_ney(spark, sf_dir).filter("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert found["sum(score)"] > found["sum(base_score)"]
