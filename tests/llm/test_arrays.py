import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from wayfare.llm.counted import Counter, pack_keys, summed, unpack_keys
from wayfare.llm.textarrays import blocks, shingle_sets

TEXT = st.lists(st.text(alphabet="abAB é\n\t漢", max_size=30) | st.none(), max_size=8)


@settings(max_examples=60, deadline=None)
@given(TEXT, st.integers(1, 40))
def test_words_of_a_column(texts, limit):
    counts, spans = [], []
    for first, part in blocks(pa.array(texts, pa.string()), limit):
        words = part.words(lower=True)
        counts += words.counts.tolist()
        spans += [part.raw[a:b].tobytes().lower() for a, b in zip(words.starts, words.ends)]
    expected = [(t or "").encode().lower().split() for t in texts]
    assert counts == [len(w) for w in expected]
    assert spans == [w for ws in expected for w in ws]


@settings(max_examples=60, deadline=None)
@given(TEXT)
def test_shingles_equal_where_words_are(texts):
    found = [set(s.tolist()) for _, part in blocks(pa.array(texts, pa.string())) for s in shingle_sets(part)]

    def plain(text):
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())

    expected = [plain(t) for t in texts]
    assert [len(s) for s in found] == [len(s) for s in expected]
    for a, x in zip(found, expected):
        for b, y in zip(found, expected):
            assert len(a & b) == len(x & y)


def test_runs_round_trip():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**64 - 1, 1000, dtype=np.uint64))
    assert (unpack_keys(pack_keys(keys), len(keys)) == keys).all()
    found, counts = summed(np.array([5, 3, 5], np.uint64), np.array([1, 2, 3]))
    assert found.tolist() == [3, 5] and counts.tolist() == [2, 4]
    empty = Counter()
    assert len(empty.merge()[0]) == 0
