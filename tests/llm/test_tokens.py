"""Token ids, token files and packing against the tokenizers library."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import corpus, nothing  # noqa: F401
from tokenizers import Tokenizer

from marketlens.llm import packing, token_files, tokens

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def library(path):
    tool = Tokenizer.from_file(path)
    tool.encode_special_tokens = True
    return lambda text: tool.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize(("path", "spaced"), [(WORDS, False), (BYTES, True)])
@settings(max_examples=400, deadline=None)
@given(text=st.text(alphabet=st.one_of(st.sampled_from(list(" \t\n\x0b\x0c\r\x85\xa0\u3000\x1c ab'sdté\u0301İΣς字😀12½._-|<>")),
                                        st.characters(codec="utf-8")), max_size=40))
def test_ids_are_those_of_the_library(path, spaced, text):
    assert np.frombuffer(tokens.encoder(path, spaced)(text), "<u4").tolist() == library(path)(text)


@pytest.mark.parametrize(("path", "spaced"), [(WORDS, False), (BYTES, True)])
def test_texts_of_more_pieces_than_the_memo_holds(path, spaced, monkeypatch):
    monkeypatch.setattr(tokens, "MEMO", 4)
    encode, texts = tokens._make(path, spaced), ["the end. ", "the one", "the. " + " ".join(f"w{k}, x{k}" for k in range(30)) + "\nthe end.",
                                                 "a.b.c, the\ttab " + " ".join(map(str, range(20))), "the end.", "\nthe . the"]
    for text in [*texts, *texts[::-1]]:
        assert np.frombuffer(encode(text), "<u4").tolist() == library(path)(text)


def test_special_tokens_are_text():
    text = "a <|endoftext|> b<|startoftext|>"
    for path, spaced in ((WORDS, False), (BYTES, True)):
        assert np.frombuffer(tokens.encoder(path, spaced)(text), "<u4").tolist() == library(path)(text)


def test_token_files_round_trip(spark, corpus, tmp_path):
    token_files.write_tokens(corpus, str(tmp_path / "t"), WORDS, 1, spaced=False)
    found = token_files.with_checksum(token_files.read_tokens(spark, str(tmp_path / "t"))).collect()
    encode, rows = library(WORDS), sorted(corpus.select("doc_id", "text").collect(), key=lambda r: (r[0] is not None, r[0] or 0))
    assert len(found) == len(rows)
    want = sorted(((r["doc_id"] is None, r["doc_id"] or 0, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
                   for r in rows for ids in [[*encode(r["text"]), 1]]))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["ids_crc32"]) for r in found) == want
    place = 0
    for r in sorted(found, key=lambda r: r["start"]):
        assert r["start"] == place
        place += r["n_tokens"]
    ids = [r["doc_id"] for r in sorted(found, key=lambda r: r["start"])]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))


def test_reading_skips_by_id(spark, corpus, tmp_path):
    token_files.write_tokens(corpus, str(tmp_path / "t"), WORDS, 1, spaced=False)
    some = token_files.read_tokens(spark, str(tmp_path / "t")).where("doc_id = 1003")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,1003)" in plan
    assert some.count() == 1


@pytest.mark.parametrize("size", [64, 1024])
def test_packing_is_whole_and_gapless(corpus, size):
    rows = packing.pack(corpus, BYTES, 2, spaced=True, size=size).collect()
    encode = library(BYTES)
    docs = defaultdict(list)
    for r in corpus.select("doc_id", "text").collect():
        docs[r["doc_id"]].append([*encode(r["text"]), 2])
    found = defaultdict(list)
    sequences = defaultdict(list)
    for r in rows:
        assert r["length"] == len(r["ids"]) <= size
        found[r["doc_id"]].append((r["piece"], r["start"], r["ids"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert found.keys() == docs.keys()
    for key, texts in docs.items():
        assert sorted(i for _, _, ids in found[key] for i in ids) == sorted(i for t in texts for i in t)
        if len(texts) == 1:
            pieces = sorted(found[key])
            assert [i for _, _, ids in pieces for i in ids] == texts[0]
            assert [p for p, _, _ in pieces] == list(range(len(pieces)))
            assert all(len(ids) == size for p, _, ids in pieces if p > 0)
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    least = -(-sum(len(t) for texts in docs.values() for t in texts) // size)
    assert len(sequences) <= 1.15 * least + 2


def test_nothing_to_encode(spark, nothing, tmp_path):
    token_files.write_tokens(nothing, str(tmp_path / "t"), WORDS, 1, spaced=False)
    assert token_files.read_tokens(spark, str(tmp_path / "t")).count() == 0
    assert packing.pack(nothing, BYTES, 2, spaced=True).count() == 0


def test_sum_of_squares_choice():
    bins = packing.SumOfSquares(10)
    assert bins.place(6) == (0, 0)  # gap 4 once
    assert bins.place(6) == (1, 0)  # no open one has room
    assert bins.place(4) == (1, 6) or bins.place(4)[1] == 6  # filling one of two lowers the sum most
    assert bins.place(10) == (2, 0)
