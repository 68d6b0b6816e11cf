import re
import zlib
from collections import Counter

import numpy as np
import pytest

from wayfare.llm import language, quality_rules
from wayfare.llm.common import table
from wayfare.llm.textarrays import Texts

from llm.conftest import prose


def plain_stats(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, seen, repeated = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)], set(), 0
    for line in lines:
        repeated += line in seen
        seen.add(line)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    n, k = len(words), len(covered)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, k, n < 10 or 100 * k > 20 * n)


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_statistics_of_odd_documents(spark, odd, odd_rows):
    labels = spark.createDataFrame([(1, 1), (2, 1), (5, 0), (999, 1), (None, 1), (4, None)], "doc_id long, quality int")
    got = quality_rules.judge(odd, labels)
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    want = sorted([(r[0], *plain_stats(r[1])) for r in odd_rows], key=key)
    assert sorted([tuple(r) for r in got.select("doc_id", *COLUMNS).collect()], key=key) == want
    assert all(not r.kept for r in got.filter("base_failed").collect())
    kept = quality_rules.kept_documents(odd, labels)
    assert kept.columns == odd.columns and kept.count() == got.filter("kept").count()


def test_without_labels_base_rules_alone(spark, odd, none):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_rules.judge(odd, labels).filter("kept = base_failed").count() == 0
    assert quality_rules.judge(none, labels).collect() == []


def test_anomalies_leave_and_good_documents_stay(spark, sf_dir):
    got = quality_rules.op4_quality(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id").filter("not base_failed").toPandas()
    good, bad = got[got.quality == 1], got[got.quality == 0]
    assert good.kept.mean() >= 0.98
    assert bad.empty or bad.kept.mean() <= 0.2


def test_far_rows_have_short_paths():
    rows = np.random.default_rng(0).normal(size=(500, 3)) * [1, 1, 0]
    forest = quality_rules.Forest(rows, np.array([1.0, 1.0, 1.0]))
    ordinary, far, other = forest.score(np.array([[0, 0, 0], [6, 0, 0], [0, 0, 3.0]]))
    assert far > ordinary + 0.1 and other > ordinary + 0.1


def test_held_out_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    got = language.op5_language(spark, sf_dir).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(got) == docs.count()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    unseen = got[got.held_out]
    assert (unseen.lang == unseen.lang_pred).mean() > 0.97
    assert got.score.between(0, 1).all()


def test_language_of_odd_documents(odd, odd_rows, none):
    got = language.identify(odd)
    assert got.count() == len(odd_rows)
    found = {r.doc_id: r for r in got.collect()}
    for i in (6, 7, 8, 16):
        assert (found[i].lang_pred, found[i].score) == ("und", 0.0)
    assert found[5].lang_pred in ("de", "en", "fr")
    assert language.identify(none).collect() == []
    kept = language.identified_documents(odd)
    assert kept.columns == odd.columns
    assert not {6, 7, 8, 16} & {r.doc_id for r in kept.collect()}


def test_only_text_decides(odd):
    from pyspark.sql import functions as F

    shuffled = odd.filter("lang is null").unionAll(odd.filter("lang is not null"))
    renamed = shuffled.withColumn("source", F.lit("other"))
    key = lambda r: (str(r.doc_id), r.lang_pred, r.score)
    assert sorted(map(key, language.identify(odd).collect())) == sorted(map(key, language.identify(renamed).collect()))


def test_nothing_to_learn_from(spark):
    rows = spark.createDataFrame([(1, "some text", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert {(r.lang_pred, r.score) for r in language.identify(rows).collect()} == {("und", 0.0)}


def test_languages_without_ids_of_their_own(spark):
    stock = {"aa": ("alto", "brisa", "campo"), "bb": ("zwölf", "yxq", "wurz"), "cc": ("kkil", "jjom", "hhep")}
    said = lambda lang, i: " ".join(stock[lang][(i >> k) % 3] + stock[lang][(i >> k) % 2] for k in range(12)) + f" {i}"
    rows = [(i, said("aa", i), "aa") for i in range(600)]
    rows += [(None if i % 3 else 1000 + i, said("bb", i), "bb") for i in range(600)]  # two thirds without an id
    one = next(i for i in range(5000, 6000) if zlib.crc32(str(i).encode()) % language.FOLDS != language.HELD_OUT)
    rows += [(one, said("cc", i), "cc") for i in range(600)] + [(one, said("cc", 0), "cc")] * 3000
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert language.train(docs).languages == ["aa", "bb", "cc"]
    want = Counter((i, lang) for i, _, lang in rows)
    assert Counter((r.doc_id, r.lang_pred) for r in language.identify(docs).collect()) == want


def test_labels_of_other_documents_take_no_place(spark, monkeypatch):
    monkeypatch.setattr(quality_rules, "FIT_ROWS", 300)
    docs = spark.createDataFrame([(i, prose(i, 80)) for i in range(200)], "doc_id long, text string")
    mine = [(i, int(i % 9 > 0)) for i in range(200)]
    few = spark.createDataFrame(mine, "doc_id long, quality int")
    many = spark.createDataFrame(mine + [(1000 + i, 1) for i in range(20_000)], "doc_id long, quality int")
    a, b = quality_rules.fit(docs, few), quality_rules.fit(docs, many)
    assert a[0] is not None and b[0] is not None and a[1] == b[1]


def test_rows_of_one_id_are_one_labelled_document(spark):
    texts = ["one two three four five six seven eight nine ten eleven", "### $$$ " * 30]
    rows = [(i, prose(i, 80)) for i in range(50)] + [(7, t) for t in texts]
    labels = spark.createDataFrame([(i, 1) for i in range(50)], "doc_id long, quality int")
    one, other = (quality_rules.fit(spark.createDataFrame(r, "doc_id long, text string"), labels) for r in (rows, rows[::-1]))
    assert one[1] == other[1]


@pytest.mark.parametrize("text", ["\u00bd \u00b2 \u2460", "\u2167", "12 34", "!!! \u0301", "\U0001f600", "_"])
def test_numerals_are_no_letters(text):
    texts = Texts(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))
    assert not language.has_letters(texts)[0]


@pytest.mark.parametrize("text", ["a", "1\u00e9", "\u6f22", "\u00aa", "\u02b0"])
def test_letters_of_any_script(text):
    texts = Texts(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))
    assert language.has_letters(texts)[0]


def test_every_labelled_row_is_learned_from(spark, monkeypatch):
    monkeypatch.setattr(quality_rules, "FIT_ROWS", 100)
    docs = spark.createDataFrame([(i, prose(i, 80)) for i in range(400)], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, int(i % 5 > 0)) for i in range(400)], "doc_id long, quality int")
    forest, threshold = quality_rules.fit(docs, labels)
    assert forest.sample == quality_rules.SAMPLE  # of the 320 good rows, more than FIT_ROWS
    good = quality_rules.judge(docs, labels).join(labels.filter("quality = 1"), "doc_id").toPandas()
    assert threshold >= np.quantile(good.anomaly, 1 - quality_rules.GOOD_LOST) - 1e-12


def test_trees_draw_the_rows_of_their_ranks(spark, monkeypatch):
    monkeypatch.setattr(quality_rules, "FIT_ROWS", 10)
    rows = [(i, *map(float, np.random.default_rng(i).normal(size=len(quality_rules.FEATURES)))) for i in range(60)]
    good = spark.createDataFrame(rows, "doc_id long, " + ", ".join(f"{c} double" for c in quality_rules.FEATURES)).repartition(4)
    whole, scale = np.array([r[1:] for r in rows]), np.ones(len(quality_rules.FEATURES))
    rng = np.random.default_rng(3)
    draws = [rng.choice(60, 8, replace=False) for _ in range(5)]
    want, got = quality_rules.Forest(whole, scale, 5, 8, 3, draws), quality_rules.grown(good, 60, scale, 5, 8, 3)
    assert (want.score(whole) == got.score(whole)).all()
