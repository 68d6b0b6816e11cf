"""Token-id files: planes, chunks, segments and documents, against the tokenizer itself."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from wayfare import session
from wayfare.llm import blockfiles, tokenfiles

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: [*tokenizer.encode(text, add_special_tokens=False).ids, 0]


@pytest.fixture(scope="module")
def encoder():
    return tokenfiles.Encoder(PATH)


PIECES = [" ", "  ", "\n", "\t", " ", " ", "\x1c", "\x85", "a", "Word", "don't", "we'll", "'s", "$$$", "a1b2", "x%%%7", "naïve", "×", "`", "[]", "{~", "x.", "x,", "7,", "7.", ".", "...", "_.", "é.", "漢字", "́", "½.", "\U0001f600", "<|endoftext|>", "\r\n", "​", "﻿"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14))
def test_pieces_encode_as_the_whole_text(plain, encoder, pieces):
    text = "".join(pieces)
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == plain(text)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_any_text_encodes_as_the_whole(plain, encoder, text):
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == plain(text)


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("dtype", ["<u4", "<i8", "u1"])
@pytest.mark.parametrize("n", [1, 7, 8, 65, 1000])
def test_planes_round_trip(bits, dtype, n):
    values = np.random.default_rng(n).integers(0, 200, n).astype(dtype)
    values[-1] = np.iinfo(np.dtype(dtype)).max
    planes = tokenfiles.to_planes(values, bits)
    assert len(planes) == values.itemsize * (8 if bits else 1)
    assert tokenfiles.from_planes(planes, n, dtype, bits).tolist() == values.tolist()


@pytest.mark.parametrize("bits", [False, True])
def test_a_file_reads_back_in_any_run(tmp_path, monkeypatch, bits):
    monkeypatch.setattr(tokenfiles, "CHUNK", 100)
    uri, ids = blockfiles.as_uri(f"{tmp_path}/one.planes"), np.arange(1234) % 50_000
    with blockfiles.replacing(uri) as out:
        writer = tokenfiles.Writer(out, bits)
        for cut in np.split(ids, [3, 250, 251, 900]):
            writer.add("ids", cut)
        writer.add("docs", np.array([-5, 7]))
        writer.close()
    with blockfiles.reading(uri) as source:
        reader = tokenfiles.Reader(source)
        assert reader.count("ids") == 1234 and reader.count("nulls") == 0
        assert reader.values("docs", 0, 2).tolist() == [-5, 7]
        for first, last in [(0, 1234), (0, 0), (99, 101), (100, 200), (1230, 1234), (5, 6)]:
            assert reader.values("ids", first, last).tolist() == ids[first:last].tolist()


def test_damage_is_noticed(tmp_path):
    uri = blockfiles.as_uri(f"{tmp_path}/one.planes")
    with blockfiles.replacing(uri) as out:
        writer = tokenfiles.Writer(out)
        writer.add("ids", np.random.default_rng(0).integers(0, 50_000, 5000))
        writer.close()
    raw = (tmp_path / "one.planes").read_bytes()
    (tmp_path / "short.planes").write_bytes(raw[:-3])
    with blockfiles.reading(blockfiles.as_uri(f"{tmp_path}/short.planes")) as source, pytest.raises(ValueError, match="not a token-id file"):
        tokenfiles.Reader(source)
    # one bit of the last plane's data: either zstandard or the checksum sees it
    (tmp_path / "bad.planes").write_bytes(raw[:40] + bytes([raw[40] ^ 4]) + raw[41:])
    with blockfiles.reading(blockfiles.as_uri(f"{tmp_path}/bad.planes")) as source, pytest.raises(Exception):
        tokenfiles.Reader(source).values("ids", 0, 5000)


def expected(rows, plain):
    found, start = [], 0
    for doc_id, text in rows:
        ids = plain(text or "")
        found.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return found


@pytest.mark.parametrize("bits", [False, True])
def test_documents_round_trip(spark, odd, odd_rows, plain, monkeypatch, bits):
    segments = tokenfiles.write_token_files(odd, session.scratch_path(spark, "ids"), bits=bits)
    got = tokenfiles.read_documents(segments, ids=True).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in got) == sorted((i is not None, i or 0, n, c) for i, _, n, c in expected([r[:2] for r in odd_rows], plain))
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.start for r in ordered] == np.cumsum([0, *[r.n_tokens for r in ordered]])[:-1].tolist()
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in ordered]
    assert keys == sorted(keys)
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.n_tokens and r.ids[-1] == 0 for r in got)
    texts = {r[0]: r[1] or "" for r in odd_rows if r[0]}
    tokenizer = Tokenizer.from_file(PATH)
    assert all(tokenizer.decode(r.ids[:-1], skip_special_tokens=False) == texts[r.doc_id] for r in got if r.doc_id)


def test_query_equals_the_tokenizer(spark, tmp_path, plain):
    rows = [(i * 3 % 101, f"text {i} of some words. " * (i % 7)) for i in range(101)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, tokenfiles.op13_token_files(spark, str(tmp_path)).collect()))
    assert got == expected(sorted(rows), plain)


def test_segments_cut_files(spark, plain):
    text = "word and more of it. " * 500
    rows = spark.range(800).selectExpr("id AS doc_id", f"concat('{text}', id % 10) AS text")
    segments = tokenfiles.write_token_files(rows, session.scratch_path(spark, "cut"), segment_ids=100_000)
    assert segments.count() > segments.select("part").distinct().count()
    got = tokenfiles.read_documents(segments).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == expected([(i, f"{text}{i % 10}") for i in range(800)], plain)


def test_no_documents_no_file(spark, none):
    assert tokenfiles.read_documents(tokenfiles.write_token_files(none, session.scratch_path(spark, "none"))).count() == 0


def test_many_words_are_merged_once(monkeypatch):
    """300,000 different words come twice; each is sent to the merges the first time only."""
    encoder, merged, original = tokenfiles.Encoder(public_tokenizers.path("byte_bpe_50k.json")), [], tokenfiles.PieceIds._merged
    monkeypatch.setattr(tokenfiles.PieceIds, "_merged", lambda self, run: merged.append(run) or original(self, run))
    letters = [chr(ord("a") + i) for i in range(26)]
    words = [letters[i % 26] + letters[i // 26 % 26] + letters[i // 676 % 26] + letters[i // 17576] for i in range(300_000)]
    text = " ".join(["start", *words])
    assert encoder.encode(text) == encoder.encode(text)
    assert len(merged) == len(words) + 1
