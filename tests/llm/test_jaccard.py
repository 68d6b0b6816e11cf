import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wayfare.llm import graph, jaccard
from wayfare.llm.textarrays import np

from llm.conftest import prose


def sets_of(rows):
    found = []
    for r in rows:
        words = (r[1] or "").encode().lower().split()
        found.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set()))
    return found


def plain(rows):
    """Least doc_id of each row's component over all pairs."""
    sets = sets_of(rows)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            same_id = rows[i][0] is not None and rows[i][0] == rows[j][0]
            if a and (100 * both >= 80 * len(a | sets[j]) or same_id):
                parent[root(i)] = root(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(r[0], least.get(root(i), r[0]))
    return [(r[0], len(s), least.get(root(i)) if s else r[0]) for i, (r, s) in enumerate(zip(rows, sets))]


KEY = lambda r: tuple((x is None, x or 0) for x in r)


def found(df):
    return sorted([tuple(r) for r in jaccard.similarity_classes(df).collect()], key=KEY)


def test_odd_documents(odd, odd_rows):
    want = [r if r[1:] != (2, None) else r for r in plain(odd_rows)]
    assert found(odd) == sorted(want, key=KEY)


def edited(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        at = rng.randrange(len(words))
        words[at : at + 1] = rng.choice([[], [f"z{rng.randrange(9)}"], [words[at], f"q{rng.randrange(9)}"]])
    return " ".join(words)


@pytest.mark.parametrize("part", [8, 4096])
def test_all_pairs_of_edited_copies(spark, monkeypatch, part):
    """Light and heavy sizes, long lists, a passage most documents share, lists in parts."""
    monkeypatch.setattr(jaccard, "LIST_PART", part)
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    rng, rows = random.Random(part), []
    shared = prose(7, 60).split()
    for family in range(12):
        size = rng.choice([5, 6, 8, 9, 11, 14, 20, 40, 120])
        base = prose(family, size).split()
        for _ in range(12):
            rows.append((len(rows), edited(rng, base, rng.randrange(0, 1 + max(1, size // 12)))))
    for i in range(60):  # mostly the shared passage, each with an own tail
        rows.append((len(rows), " ".join(shared + prose(1000 + i, rng.randrange(5, 40)).split())))
    for i in range(40):  # near copies of each other around the passage
        rows.append((len(rows), edited(rng, shared + prose(3, 30).split(), 2)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(df) == sorted(plain(rows), key=KEY)


def test_empty(none):
    assert jaccard.similarity_classes(none).collect() == []
    assert jaccard.distinct_documents(none).collect() == []


def kept_plainly(rows):
    """How many documents stay: one of each class of sets over all rows, whatever their ids, and all without words."""
    alone = plain([(i, r[1]) for i, r in enumerate(rows)])
    return len({c for _, n, c in alone if n}) + sum(n == 0 for _, n, _ in alone)


def test_one_document_of_each_class(odd, odd_rows):
    kept = jaccard.distinct_documents(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()
    assert len(rows) == kept_plainly(odd_rows)
    ids = [r.doc_id for r in rows]
    # the copy without id goes, the text that nobody else has stays; of a named class the least id
    assert sum(i is None for i in ids) == 1 and {1, 5, 18} <= set(ids) and not {2, 3, 4} & set(ids)


def test_ids_that_are_null_or_shared(spark):
    """Half the rows have no id, others share one: copies go, different texts stay."""
    rng, rows = random.Random(3), []
    for family in range(30):
        base = prose(900 + family, 60)
        for k in range(4):
            rows.append((None if k % 2 else 7, base if k < 2 else edited(rng, base.split(), 1)))
    rows += [(None, None), (None, None), (3, ""), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    kept = [r.text for r in jaccard.distinct_documents(df).collect()]
    assert len(kept) == 30 + 4 and len({t for t in kept if t}) == 30


def test_copies_are_no_hot_key(spark, monkeypatch):
    """Half of all rows are one text: it is listed once a task."""
    page = prose(1, 80)
    rows = [(i, page if i % 2 else prose(i, 60, 4000)) for i in range(8000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6).cache()
    none = np.zeros(0, np.int64)
    keys = df.select("text").mapInArrow(jaccard._postings(none, none, 5, 1, 80), jaccard.POSTINGS)
    largest = keys.groupBy("h", "part").count().agg({"count": "max"}).first()[0]
    assert largest <= 60 < jaccard.LIST_PART
    classes = jaccard.similarity_classes(df)
    assert classes.filter("doc_id % 2 = 1 and component_id != 1").isEmpty()


def test_texts_around_one_passage_are_not_compared(spark, monkeypatch):
    """300 shared and 50 own words: no link, and next to no pair to look at."""
    passage, dealt = prose(2, 300, 10_000), []
    original = jaccard.dealt_blocks

    def counted(*args):
        made = original(*args)
        dealt.append(made.count())
        return made

    monkeypatch.setattr(jaccard, "dealt_blocks", counted)
    rows = [(i, passage + " " + prose(5000 + i, 50, 100_000)) for i in range(5000)]
    got = jaccard.similarity_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(8))
    assert got.filter("doc_id != component_id").isEmpty()
    assert dealt[0] <= 5000


def test_a_large_group_costs_a_pair_a_member(spark, monkeypatch):
    """300 near copies that nearly all link with each other but not with the one of the least id: far fewer pairs than every two are met."""
    rng, met = random.Random(11), []
    base = prose(40, 200, 50_000).split()
    # the least id has a foreign half, so it shares lists with all and links with none
    rows = [(0, " ".join(base[:120] + prose(41, 80, 50_000).split()))]
    rows += [(i, edited(rng, base, 1 + i % 3)) for i in range(1, 301)]
    original = jaccard.verified

    def counted(docs, edges, *args):
        met.append(edges.count())
        return original(docs, edges, *args)

    monkeypatch.setattr(jaccard, "verified", counted)
    monkeypatch.setattr(jaccard, "BLOCK", 64)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(df) == sorted(plain(rows), key=KEY)
    assert sum(met[1:]) <= 10 * len(rows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 15), st.integers(0, 15)), max_size=80), st.lists(st.integers(0, 9), min_size=16, max_size=16))
def test_forest(pairs, label):
    """The pairs that join two classes when they are taken one after the other."""
    joined, want = list(label), []
    for at, (x, y) in enumerate(pairs):
        if joined[x] != joined[y]:
            want.append(at)
            joined = [joined[y] if k == joined[x] else k for k in joined]
    a, b = (np.array([p[side] for p in pairs], np.int64) for side in (0, 1))
    assert jaccard.forest(np.array(label), a, b).tolist() == want


def test_poor_and_rich_sets_meet(spark, monkeypatch):
    """Texts of a passage with few and with more own words, some of which link across."""
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    passage = prose(2, 120, 10_000)
    rows = [(i, passage + " " + prose(5000 + i, i % 31, 100_000)) for i in range(150)]
    rows += [(1000 + i, prose(9000 + i, 60, 100_000)) for i in range(600)]
    assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == sorted(plain(rows), key=KEY)


@pytest.mark.parametrize("most", [1 << 29, 0])
def test_ids_in_a_bitmap(spark, monkeypatch, most):
    monkeypatch.setattr(jaccard, "MOST_BITS", most)
    docs = spark.range(-500, 200_000).selectExpr("id AS doc_id", "'t' AS text").unionAll(spark.sql("SELECT CAST(NULL AS BIGINT), 'n'"))
    ids = spark.range(0, 200_000, 7).selectExpr("id AS doc_id")
    inside, outside = jaccard.with_ids(docs, ids, True), jaccard.with_ids(docs, ids, False)
    assert inside.columns == docs.columns
    assert outside.join(ids, "doc_id").isEmpty() and inside.join(ids, "doc_id").count() == ids.count()
    assert inside.count() < ids.count() + 25_000 and inside.count() + outside.count() == docs.count()
    assert inside.filter("doc_id is null").isEmpty()
    assert jaccard.with_ids(docs, ids.limit(0), True).isEmpty()


@settings(max_examples=100, deadline=None)
@given(st.sets(st.integers(0, 2**40), max_size=1500), st.sets(st.integers(0, 2**40), max_size=40), st.integers(0, 60))
def test_signatures_never_drop_a_link(base, extra, dropped):
    one = np.array(sorted(base), np.uint64)
    other = np.array(sorted(set(sorted(base)[dropped:]) | extra), np.uint64)
    both, either = len(set(one.tolist()) & set(other.tolist())), len(set(one.tolist()) | set(other.tolist()))
    if either and 100 * both >= 80 * either:
        assert jaccard.may_link(jaccard.signature(one), jaccard.signature(other), len(one), len(other))


def test_needed_overlap():
    for n in range(1, 40):
        for m in range(1, 40):
            least = next((i for i in range(0, min(n, m) + 1) if 100 * i >= 80 * (n + m - i)), None)
            if least is not None:
                assert jaccard.needed(n, m) == least
                assert jaccard.needed(n, m) > n - jaccard.prefix_length(n)


def test_components(spark):
    rng = random.Random(5)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 470)] + [(500, 500 + i) for i in range(1, 60)]
    label = {v: v for p in pairs for v in p}
    for _ in range(600):
        before = dict(label)
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
        if label == before:
            break
    got = {r.id: r.label for r in graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {v: k for v, k in label.items() if v != k}
