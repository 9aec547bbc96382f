"""Dictionary segmentation against plain search over all paths."""

from __future__ import annotations

import functools
import random
import sys

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marketlens.operators import segment as sg

WORDS = {"中国": 3.0, "中国人": 2.0, "人民": 5.0, "民": 0.5, "中": 0.1, "国人": 1.0, "银行": 2.0, "行": 0.2, "手机": 1.0, "苹果": 1.0, "苹果手机": 0.5}


def plain_path(text, words):
    """All cuts, best by characters outside, words, weight, and longer first words."""
    @functools.cache
    def best(i):
        if i == len(text):
            return (0, 0, 0.0), ()
        found = []
        for j in range(i + 1, len(text) + 1):
            w = text[i:j]
            if w in words or j == i + 1:
                (out, n, weight), rest = best(j)
                # A character outside the dictionary counts; one in it may also be passed over, at the same price.
                if w in words:
                    found.append(((out, n + 1, round(weight - words[w], 9)), -j, (w, *rest)))
                if j == i + 1:
                    found.append(((out + 1, n + 1, round(weight, 9)), -j, (w, *rest)))
        key, _, path = min(found, key=lambda f: (f[0], f[1]))
        return key, path
    return list(best(0)[1])


def test_best_path_equals_plain_search():
    rng = random.Random(3)
    letters = "中国人民银行手机苹果的x"
    trie = sg.Trie(WORDS)
    for _ in range(500):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 14)))
        path = sg.best_path(text, trie)
        assert path == plain_path(text, WORDS) and "".join(path) == text


@pytest.mark.parametrize("text,want", [
    ("中国人民银行", ["中国", "人民", "银行"]), ("买Apple苹果手机15 Pro，好！", ["买", "apple", "苹果手机", "15", "pro", "好"]),
    ("the quick_fox", ["the", "quick", "fox"]), (None, []), ("", []), (" ，_ ", []), ("苹果 手机", ["苹果", "手机"]),
])
def test_mixed_texts(spark, text, want):
    assert sg.words_in(text, sg.Trie(WORDS)) == want
    df = spark.createDataFrame([(1, text)], "id INT, t STRING")
    assert [r.word for r in sg.segmented_words_of(df, "t", ["id"], WORDS).collect()] == want


def test_texts_that_lost_their_blanks(spark):
    words = sg.dictionary(spark.createDataFrame([("The", 2), ("then", 1), ("end", 1), ("hen", 3), ("", 9)], "word STRING, n INT"), weight="n")
    assert words == {"the": 2.0, "then": 1.0, "end": 1.0, "hen": 3.0}
    assert sg.words_in("TheEnd thenend", sg.Trie(words), spaced=True) == ["the", "end", "then", "end"]
    long = "theend" * 20_000
    df = spark.createDataFrame([(1, long)], "id INT, t STRING")
    got = sg.segmented_words_of(df, "t", ["id"], words, spaced=True).groupBy("word").agg(F.count("*").alias("n")).collect()
    assert {(r.word, r.n) for r in got} == {("the", 20_000), ("end", 20_000)}


def test_a_dictionary_has_a_bound(spark, monkeypatch):
    monkeypatch.setattr(sg, "MAX_WORDS", 5)
    with pytest.raises(ValueError, match="at most 5 words"):
        sg.dictionary(spark.range(6).select(F.col("id").cast("string").alias("word")))


@pytest.mark.parametrize("table", [0, sg.TABLE])
def test_many_stretches_at_once_equal_the_search_of_each(monkeypatch, table):
    monkeypatch.setattr(sg, "TABLE", table)
    monkeypatch.setattr(sg, "BLOCK", 3_000)
    rng = random.Random(5)
    letters = "abcde"
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(2, 6))): rng.choice([0.0, 0.5, 1.0, 2.5]) for _ in range(150)} | {"a": 0.1}
    texts = ["".join(rng.choice(letters + "x中. ") for _ in range(rng.choice([0, 3, 40, 900]))) for _ in range(120)]
    texts += [None, "", "\n\n", "ab" * 3_000, " , ", "x"]
    trie, cutter = sg.Trie(words), sg.Cutter(words)
    for spaced in (True, False):
        assert cutter.words_in(texts, spaced) == [sg.words_in(t, trie, spaced) for t in texts]
    assert sg.Cutter({}).words_in(["ab c", None], True) == [sg.words_in("ab c", sg.Trie({}), True), []]


def test_the_cost_of_a_letter_is_no_python_call():
    cutter, calls = sg.Cutter({"the": 1.0, "then": 0.5, "end": 1.0, "hen": 0.2, "he": 0.1, "nd": 0.1}), 0
    texts = ["thenendthendxtheend" * 20] * 500

    def count(*_):
        nonlocal calls
        calls += 1

    sys.setprofile(count)
    try:
        cutter.words_in(texts, spaced=True)
    finally:
        sys.setprofile(None)
    assert calls < sum(map(len, texts)) / 4


def test_words_of_a_block_only_are_held_at_a_time(monkeypatch):
    """A batch of many texts becomes Arrow lists block by block, so that its words are never all Python objects at once."""
    monkeypatch.setattr(sg, "BLOCK", 3_000)
    cutter, sizes, words_in = sg.Cutter({"the": 1.0, "then": 0.5, "end": 1.0}), [], sg.Cutter.words_in
    monkeypatch.setattr(sg.Cutter, "words_in", lambda self, texts, spaced=False: sizes.append(sum(len(t or "") for t in texts)) or words_in(self, texts, spaced))
    texts = ["thenendthe" * 20, None, "", "Ä end"] * 100 + ["the" * 5_000, "end"]
    found = cutter.arrays(pa.array(texts), True)
    assert found.to_pylist() == words_in(cutter, texts, True)
    assert len(sizes) >= 8 and sorted(sizes)[-2] <= 3_000 and max(sizes) == 15_000
    assert cutter.arrays(pa.array(texts)[100:103], True).to_pylist() == words_in(cutter, texts[100:103], True)
    assert cutter.arrays(pa.array([], pa.string())).to_pylist() == []
    assert cutter.arrays(pa.array([None, None], pa.string())).to_pylist() == [[], []]
