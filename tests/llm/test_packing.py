import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from wayfare.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def by_word():
    return packing.WordEncoder(PATH)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abtTsS.,'!é É́Ḧ̂hK 1½漢\n\t  \x1c<|>", max_size=40) | st.text(max_size=20))
def test_words_encode_like_whole_texts(whole, by_word, text):
    assert by_word.encode(text.encode("utf-8", "ignore")).tolist() == [*whole.encode(text.encode("utf-8", "ignore").decode(), add_special_tokens=False).ids, 1]


def test_pieces_restore_every_document(odd, odd_rows, whole):
    got = packing.pack(odd).toPandas()
    texts = {}
    for r in odd_rows:
        ids = [*whole.encode(r[1] or "", add_special_tokens=False).ids, 1]
        texts.setdefault(r[0], []).append(np.array(ids, "<u4"))
    assert got.length.sum() == sum(len(t) for ts in texts.values() for t in ts)
    for doc_id, ids in ((i, ts[0]) for i, ts in texts.items() if i is not None and len(ts) == 1):
        at = 0
        for piece in got[got.doc_id == doc_id].sort_values("start").itertuples():
            assert (piece.start, piece.doc_tokens) == (at, len(ids))
            at += piece.length
            assert zlib.crc32(ids[piece.start : at].tobytes()) == piece.ids_crc32
        assert at == len(ids)
    for _, pieces in got.groupby("sequence_id"):
        pieces = pieces.sort_values("offset")
        assert (pieces.offset == pieces.length.cumsum() - pieces.length).all()
        assert pieces.length.sum() <= packing.WINDOW


def test_empty(none):
    assert packing.pack(none).collect() == []


def cheapest(places, penalty, window):
    cost = [0.0] + [float("inf")] * (len(places) - 1)
    for i in range(1, len(places)):
        for j in range(i):
            length = places[i] - places[j]
            if length <= window:
                pad = window - length
                if length & (length - 1) == 0 and length >= packing.SHORTEST:
                    pad = min(pad, 0 if length == window else packing.SHORT_PENALTY)
                cost[i] = min(cost[i], cost[j] + pad + penalty[i])
    return cost[-1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 90), st.sampled_from([0.0, 8.0, 64.0])), min_size=1, max_size=40))
def test_cuts_are_the_cheapest(steps):
    places = np.concatenate([[0], np.cumsum([n for n, _ in steps])])
    penalty = np.array([0.0, *[p for _, p in steps[:-1]], 0.0])
    cuts = packing.cut_windows(places, penalty, 128)
    assert cuts[0] == 0 and cuts[-1] == places[-1]
    at = {int(p): q for p, q in zip(places, penalty)}
    total = 0.0
    for a, b in zip(cuts, cuts[1:]):
        length = b - a
        pad = 128 - length
        if length & (length - 1) == 0 and length >= packing.SHORTEST:
            pad = min(pad, 0 if length == 128 else packing.SHORT_PENALTY)
        total += pad + at[b]
    assert total == pytest.approx(cheapest(places.tolist(), penalty.tolist(), 128))


def test_little_padding(spark, sf_dir):
    lengths = packing.op3_packing(spark, sf_dir).groupBy("sequence_id").sum("length").toPandas()["sum(length)"]
    padding = sum(0 if n & (n - 1) == 0 else packing.WINDOW - n for n in lengths)
    assert padding < 0.02 * lengths.sum()
