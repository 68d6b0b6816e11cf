import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wayfare.llm import fingerprints, hosts, licences, tokencounts
from wayfare.llm.common import LOWER, UPPER

NOTICES = [
    "Licensed under CC BY-NC 4.0. All Rights\nReserved",
    "GNU General Public License version 2 or later; gnu general public license",
    "SPDX-License-Identifier: Apache-2.0 / MIT License",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
    "cc by cc by, CC_BY cc-by-sa 3.0",
    "accby all rights reserved" + " filler" * 500 + " all rights reserved",
    "İ K all rightſ reserved",
    None,
    "",
    "!!! ...",
]


def plain(text):
    low = (text or "").translate(str.maketrans(UPPER, LOWER))
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places, base = [], set()
    for phrase, label in licences.BASE:
        wanted = phrase.split()
        for i in range(len(words) - len(wanted) + 1):
            if words[i : i + len(wanted)] == wanted:
                places.append(i)
                base.add(label)
    spaced = f" {' '.join(words)} "
    found = [
        (m.start(), m.end(), rule.priority, n, rule.label)
        for n, rule in enumerate(licences.RULES)  # all of them: the keywords only spare work
        for m in re.finditer(f" {rule.pattern}(?= )", spaced)
    ]

    def beaten(m, o):
        return o[0] <= m[0] and o[1] >= m[1] and o[2] <= m[2] and (o[1] - o[0] > m[1] - m[0] or o[2] < m[2] or o[3] < m[3])

    kept = [m for m in found if not any(beaten(m, o) for o in found)]
    best = licences.CONFIDENCE[min(m[2] for m in kept)] if kept else 0.0
    score = max(best, licences.BASE_CONFIDENCE if places else 0.0)
    ends = (min(places), max(places)) if places else (None, None)
    return (len(words), len(places), *ends, ",".join(sorted(base)), ",".join(sorted(base | {m[4] for m in kept})), score)


def test_licences_against_plain_scan(spark, odd_rows):
    texts = NOTICES + [r[1] for r in odd_rows]
    df = spark.createDataFrame([(i, t, "x", 3) for i, t in enumerate(texts)], "doc_id long, text string, words string, row int")
    got = licences.scan(df)
    assert {r.doc_id: tuple(r)[1:] for r in got.collect()} == {i: plain(t) for i, t in enumerate(texts)}
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_licences_of_one_word_again_and_again(spark):
    texts = ["gpl word " * 500, "gpl v2 or later mit license " * 60, "cc by cc by 4 0 " * 100]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: tuple(r)[1:] for r in licences.scan(df).collect()} == {i: plain(t) for i, t in enumerate(texts)}
    long = spark.createDataFrame([(1, "gpl word " * 60_000)], "doc_id long, text string")
    row = licences.scan(long).first()  # linear in its matches: seconds, where all pairs of them took minutes
    assert (row.n_words, row.labels) == (120_000, plain("gpl word")[5])


def test_licence_labels(spark, none):
    by = {t: plain(t)[5] for t in NOTICES if t}
    assert "cc-by-nc-4.0" in by[NOTICES[0]] and "cc-by" in by[NOTICES[0]] and "reserved" in by[NOTICES[0]]
    assert "gpl-2-or-later" in by[NOTICES[1]]
    assert "apache-2.0" in by[NOTICES[2]] and "mit" in by[NOTICES[2]]
    assert len(licences.RULES) > 300
    assert licences.scan(none).collect() == []


def said_by(pattern):
    """Strings that a rule's pattern matches: every branch, with and without every optional part, its first character of a class."""
    from re import _constants, _parser

    def options(parts):
        found = [""]
        for op, arg in parts:
            if op is _constants.LITERAL:
                more = [chr(arg)]
            elif op is _constants.IN:
                more = ["1"] if arg[0][0] is _constants.CATEGORY else [chr(a) for _, a in arg]
            elif op is _constants.BRANCH:
                more = [x for branch in arg[1] for x in options(branch)]
            elif op is _constants.SUBPATTERN:
                more = options(arg[3])
            else:
                assert op is _constants.MAX_REPEAT, op
                low, high, inner = arg
                more = [x for n in sorted({low, min(low + 1, high)}) for x in options(list(inner) * n)]
            found = [a + b for a in found for b in more]
        return found

    return options(_parser.parse(pattern))


def test_keywords_stand_in_every_match():
    for rule in licences.RULES:
        said = said_by(rule.pattern)
        assert said and all(re.fullmatch(rule.pattern, x) for x in said)
        assert [x for x in said if f" {rule.keyword}" not in f" {x}"] == [], rule


def test_licences_spelled_the_other_way(spark):
    texts = {
        "under the GNU General Public Licence version 3 or later": "gpl-3-or-later",
        "GNU Lesser General Public Licence": "lgpl",
        "the lesser general public licence": "lgpl",
        "GNU Affero General Public Licence 3": "agpl-3",
        "affero general public licence": "agpl",
        "GNU Free Documentation Licence 1.3": "gfdl-1.3",
        "open data commons database licence 1.0": "odbl-1.0",
        "Unauthorized copying of this file is prohibited": "proprietary",
    }
    got = licences.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    found = {r.doc_id: r.labels.split(",") for r in got.collect()}
    assert [label for i, label in enumerate(texts.values()) if label not in found[i]] == []


def test_fingerprints_against_plain_edit(odd, odd_rows):
    got = fingerprints.fingerprints(odd).collect()
    assert len(got) == len(odd_rows)
    named = sorted([r for r in odd_rows if r[0] is not None], key=lambda r: r[0])
    nulls = {r[1] for r in odd_rows if r[0] is None}
    shared = {}
    for r in got:
        if r.doc_id is None:
            continue
        text = next(x[1] or "" for x in named if x[0] == r.doc_id)
        assert shared.setdefault(text, r.fingerprint) == r.fingerprint
        after = [x[1] or "" for x in named if x[0] > r.doc_id] or sorted(nulls)
        same = [x[1] or "" for x in named if x[0] == r.doc_id][1:]
        half = len(text) // 2
        options = {text[: len(text) - half] + n[:half] for n in [after[0], *same, *(nulls if r.doc_id == named[-1][0] else [])]}
        assert r.n_chars == len(text)
        assert r.edited_sha256 in {hashlib.sha256(o.encode()).hexdigest() for o in options}
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1


def test_fingerprints_at_the_edges(spark, none):
    assert fingerprints.fingerprints(none).collect() == []
    row = fingerprints.fingerprints(spark.createDataFrame([(5, "abcd" * 40)], "doc_id long, text string")).first()
    assert row.edited_sha256 == hashlib.sha256(("abcd" * 40).encode()).hexdigest() and row.near_next == row.near_edited == 1.0
    blank = fingerprints.fingerprints(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).collect()
    assert {(r.n_chars, r.fingerprint, r.near_next) for r in blank} == {(0, "", 1.0)}


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=4000))
def test_chunks_cover_the_text(data):
    ends = fingerprints.boundaries(np.frombuffer(data, np.uint8))
    assert ends == sorted(set(ends)) and (ends[-1:] == [len(data)] if data else ends == [])
    sizes = np.diff([0, *ends])
    assert (sizes <= fingerprints.MOST).all() and (sizes[:-1] >= fingerprints.LEAST).all()


def test_chunks_survive_a_shift():
    text = " ".join(hashlib.sha256(str(i).encode()).hexdigest() for i in range(400)).encode()
    moved = text[:3000] + b"inserted words" + text[3000:]
    assert fingerprints.containment(fingerprints.chunk_set(text), fingerprints.chunk_set(moved)) > 0.95


def test_gear_depends_on_32_bytes():
    data = np.random.default_rng(2).integers(0, 256, 500).astype(np.uint8)
    assert (fingerprints.gear(data)[100:] == fingerprints.gear(data[60:])[40:]).all()


def test_tokens_add_up(odd, odd_rows, none):
    import public_tokenizers

    encoding, lengths = tokencounts.load_encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    got = tokencounts.section_tokens(odd).toPandas()
    for r in odd_rows:
        if r[0] is None or r[0] == 18:
            continue
        own = got[got.doc_id == r[0]].sort_values("section")
        text = r[1] or ""
        assert own.n_tokens.sum() == len(encoding.encode_ordinary(text)) == own.doc_tokens.iloc[0]
        assert own.end.iloc[-1] == len(text) and (own.start.iloc[1:].values == own.end.iloc[:-1].values).all()
        assert "".join(text[a:b] for a, b in zip(own.start, own.end)) == text
    assert tokencounts.section_tokens(none).collect() == []


def test_crossing_tokens_go_to_the_larger_part():
    raw = np.frombuffer("ab\ncdéf\ng".encode(), np.uint8)
    starts = tokencounts.section_starts(raw)
    assert starts.tolist() == [0, 3, 9]
    # tokens: "a", "b\nc" (two characters before the break, one after), "d", half of "é" and the other half with "f", "\ng"
    counts, crossing, edges = tokencounts.attribute(raw, np.array([1, 4, 5, 6, 8, 10]), starts)
    assert counts.tolist() == [2, 4, 0] and crossing.tolist() == [1, 1, 0]
    assert edges.tolist() == [0, 3, 8, 9]


PAGES = [
    (1, "http://good.org/fr/1", '<a href="http://mid.example.edu/x">m</a><a href="/own">o</a>'),
    (2, "https://mid.example.edu/", '<a class=c href=//far.example.edu/y>f</a>'),
    (3, "http://far.example.edu", None),
    (4, "http://Spam.NET/a?b#c", "<p>none</p>"),
    (5, "http://linker.example.info/p", "<a href='http://spam.net/1'>1</a><A HREF='http://SPAM.net/2'>2</a>"),
    (6, "http://www.example.net/en/x", ""),
    (7, "http://a.example.com/de/1?x=://y", ""),
    (8, "http://a.example.com/fr/1", ""),
    (9, None, "<a href='http://spam.net/1'>1</a>"),
    (10, "no scheme here", ""),
    (11, "http://x.net?q=/", ""),
    (12, "ftp://one://two/three", ""),
    (12, "ftp://one://two/three", ""),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "h", "t", 1.0) for p in PAGES], "page_id long, url string, html string, host string, `to` string, mass double")


def test_urls_and_rules(pages):
    got = {r.page_id: r for r in hosts.judge(pages).collect()}
    assert (got[4].host, got[4].path, got[4].rule, got[4].verdict) == ("spam.net", "/a", "net/", "block")
    assert (got[6].rule, got[6].verdict) == ("example.net/en/", "allow")
    assert (got[7].rule, got[7].verdict) == ("example.com/de/", "block")
    assert (got[1].rule, got[1].verdict) == ("org/fr/", "allow")
    assert (got[9].host, got[9].path, got[10].host, got[3].path) == ("", "", "", "")
    assert got[9].verdict == got[10].verdict == "allow"
    assert got[11].rule is None and (got[12].host, got[12].path) == ("one:", "//two/three")
    assert got[5].verdict == "block" and got[5].distrust > 0  # links to a blocked host
    assert got[2].verdict == "allow" and got[2].trust > got[3].trust > 0


def test_host_sql(pages):
    import duckdb

    from compare import differences

    con = duckdb.connect()
    con.register("pages", pages.select("page_id", "url", "html").toPandas())
    assert differences(hosts.judge(pages).toPandas(), con.execute(hosts.sql()).df()) == ""


def host_sql_rows(pages):
    import duckdb

    con = duckdb.connect()
    con.register("pages", pages.select("page_id", "url", "html").toPandas())
    return con.execute(hosts.sql()).df().sort_values("page_id", ignore_index=True)


def linked(spark, edges, n):
    """Pages of n hosts, the first two blocked, the next two allowed, with links to each other."""
    url = lambda i: f"http://h{i}.{'net' if i < 2 else 'org' if i < 4 else 'info'}/fr/"
    rows = [(i, url(i), " ".join(f"<a href='{url(b)}'>x</a>" for a, b in edges if a == i)) for i in range(n)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


@pytest.mark.parametrize("kind", ["chain", "circle", "random"])
def test_host_sql_on_linked_pages(spark, kind):
    rng = np.random.default_rng(8)
    edges = {"chain": [(i + 1, i) for i in range(30)], "circle": [(i, (i + 1) % 12) for i in range(12)] + [(5, 0), (2, 9)], "random": rng.integers(0, 25, (70, 2)).tolist()}[kind]
    pages = linked(spark, edges, 31)
    got, want = hosts.judge(pages).toPandas().sort_values("page_id", ignore_index=True), host_sql_rows(pages)
    for c in ("page_id", "host", "path", "rule", "verdict"):
        assert got[c].fillna("-").tolist() == want[c].fillna("-").tolist()
    for c in ("trust", "distrust"):
        assert got[c].tolist() == pytest.approx(want[c].tolist(), abs=hosts.REMAINDER)
    assert (got.distrust > 0).sum() > 3 and (got.trust > 0).sum() > 3


def test_an_address_in_a_query_is_no_link(spark):
    rows = [
        (1, "http://clean.info/", "<a href='/login?next=http://spam.net/x'>a</a><a href='go?u=//spam.net'>b</a><a href='x.html#http://spam.net'>c</a>"),
        (2, "http://bad.info/", "<a href='//spam.net/x'>a</a>"),
        (3, "http://worse.info/", "<a href='HTTPS://spam.net/x'>a</a>"),
        (4, "http://spam.net/", ""),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in hosts.judge(pages).collect()}
    assert got[1].distrust == 0 and got[1].verdict == "allow"
    assert got[2].distrust == got[3].distrust > 0.05 and got[4].verdict == "block"  # both share what spam.net sends back
    assert (host_sql_rows(pages).distrust > 0).tolist() == [False, True, True, True]


def test_no_pages(pages):
    got = hosts.judge(pages.limit(0))
    assert got.collect() == []
    plan = hosts.judge(pages)._jdf.queryExecution().toString()
    assert "Python" not in plan


def test_settled_walk_against_the_limit(spark):
    rng = np.random.default_rng(4)
    edges = {(int(a), int(b)): int(n) for a, b, n in rng.integers(1, 9, (30, 3)) if a != b}
    df = spark.createDataFrame([(str(a), str(b), n) for (a, b), n in edges.items()], "`from` string, `to` string, links long")
    got = {int(r.host): r.mass for r in hosts.settle(df, spark.createDataFrame([("1", 1.0), ("2", 0.5)], "host string, weight double")).collect()}
    step = np.zeros((9, 9))
    for (a, b), n in edges.items():
        step[b, a] = n / sum(m for (x, _), m in edges.items() if x == a)
    start = np.zeros(9)
    start[1], start[2] = 1.0, 0.5
    limit = np.linalg.solve(np.eye(9) - hosts.DAMPING * step, (1 - hosts.DAMPING) * start)
    short = limit - [got.get(i, 0.0) for i in range(9)]
    assert short.min() > -1e-12 and short.sum() <= hosts.REMAINDER


def test_long_chains_do_not_hold_mass_under_way(spark):
    chain = [(0, "http://spam.net/", "")]
    chain += [(i, f"http://h{i}.example.info/", f"<a href='http://{'spam.net' if i == 1 else f'h{i - 1}.example.info'}/'>x</a>") for i in range(1, 16)]
    got = {r.page_id: r for r in hosts.judge(spark.createDataFrame(chain, "page_id long, url string, html string")).collect()}
    limit = {i: 0.15 * 0.85**i for i in range(16)}
    assert {i: r.distrust for i, r in got.items()} == pytest.approx(limit, abs=hosts.REMAINDER)
    assert {i for i, r in got.items() if r.verdict == "block"} == {i for i, m in limit.items() if m >= hosts.THRESHOLD}
