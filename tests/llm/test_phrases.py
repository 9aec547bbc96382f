"""Phrase collocations against plain counting."""

from __future__ import annotations

import collections
import random
import re

import numpy as np
import pytest
from llm_cases import SCHEMA, corpus, edge_rows, nothing, word  # noqa: F401
from pyspark.sql import functions as F

from marketlens.llm import collocations


def fold(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def plain(rows, least, top):
    """All phrases by lists and dictionaries: lang, rank, phrase, a, l, r, n, score."""
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", fold(text)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in range(1, 5) for i in range(len(w) - k + 1))
    often = {k: a for k, a in f.items() if a >= least}
    out = []
    for (lang, w), a in often.items():
        if len(w) == 1 or any(len(v) > len(w) and other == lang and 100 * b >= 80 * a
                              and any(v[i:i + len(w)] == w for i in range(len(v))) for (other, v), b in often.items()):
            continue
        cuts = [(2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.append((lang, " ".join(w), a, f[lang, w[:k]], f[lang, w[k:]], n[lang], score))
    out.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    ranks = collections.Counter()
    for r in out:
        ranks[r[0]] += 1
        if ranks[r[0]] <= top:
            yield r[0], ranks[r[0]], *r[1:]


def mined(df, **options):
    return sorted(tuple(r) for r in collocations.phrases(df, **options).collect())


def random_rows(seed, n=150):
    rng = random.Random(seed)
    fixed = [" ".join(word(rng, 1) for _ in range(rng.randint(2, 5))) for _ in range(12)]
    rows = []
    for i in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.4 else word(rng, 1).upper() for _ in range(rng.randint(0, 40))]
        glue = [rng.choice([" ", " ", "\t ", ", ", "\n", "."]) for _ in parts]
        rows.append((i, "".join(a + b for a, b in zip(parts, glue)), rng.choice(["en", "de", None]), "s", 0, "w", 1, 2))
    return rows


@pytest.mark.parametrize("least,top", [(3, 2000), (8, 7)])
def test_phrases_equal_plain_counts(spark, corpus, least, top):  # noqa: F811
    extra = spark.createDataFrame(random_rows(least), SCHEMA)
    rows = corpus.where(F.length("text") < 100_000).unionByName(extra)
    want = sorted(plain([(r["lang"], r["text"]) for r in rows.collect()], least, top))
    assert mined(rows, min_count=least, top=top) == want and len(want) > 10


def test_dense_tiles_and_coordinates_agree(spark, monkeypatch):
    rows = spark.createDataFrame(random_rows(11, 300), SCHEMA)
    want = mined(rows, min_count=4)
    monkeypatch.setattr(collocations, "DENSE_LANGS", 0)  # no unit has a rank: all pairs are coordinates
    assert mined(rows, min_count=4) == want == sorted(plain([(r["lang"], r["text"]) for r in rows.collect()], 4, 2000))


def test_pairs_of_all_tiles_are_counted():
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(1, 1 << 60, 3000).astype(np.uint64))
    rng.shuffle(keys)
    heads = [keys[:collocations._RANKS], keys[collocations._RANKS:collocations._RANKS + 300]]
    units = keys[(rng.zipf(1.3, 200_000) - 1) % len(keys)]
    tally = collocations._Tally(heads)
    batches = [*tally.add(units, np.arange(len(units) - 1)), *tally.finish()]
    assert len(tally.dense) == 2 and sum(b.num_rows for b in batches[:-2]) > 0
    got = collections.Counter()
    for b in batches:
        for u, v, n in zip(*(b.column(k).to_pylist() for k in (0, 1, 2))):
            got[u, v] += n
    assert got == collections.Counter(zip(units[:-1].view(np.int64).tolist(), units[1:].view(np.int64).tolist()))


def test_edge_cases(spark, corpus, nothing):  # noqa: F811
    assert mined(nothing) == []
    few = spark.createDataFrame([(1, "a b. a b. A B", None, "s", 0, "w", 1, 2), (None, None, "en", "s", 0, "w", 1, 2),
                                 (2, "", "en", "s", 0, "w", 1, 2), (2, "one", "de", "s", 0, "w", 1, 2)], SCHEMA)
    assert mined(few, min_count=3) == [("und", 1, "a b", 3, 3, 3, 6, 1_000_000)]
    assert mined(few) == []
    long = spark.createDataFrame([(1, "x y " * 300_000, "en", "s", 0, "w", 1, 2), (1, "q" * 2_000_000, "en", "s", 0, "w", 1, 2)], SCHEMA)
    assert [r[2] for r in mined(long)] == ["x y x y", "y x y x"]


def test_tokens_do_not_depend_on_segments(monkeypatch):
    rng = random.Random(4)
    data = "".join(rng.choice(["ab", "É", " ", "\t", ".", "\n", "Zz", "\U0001f600"]) for _ in range(5000)).encode()
    whole = collocations.tokens(data)
    monkeypatch.setattr(collocations, "SEGMENT_BYTES", 37)
    parts = collocations.tokens(data)
    assert all((a == b).all() for a, b in zip(whole, parts))
    words = [w for w in re.split("[ \t.\n]+", data.decode()) if w]
    assert [data[a:b].decode() for a, b in zip(*whole[:2])] == words
    hashes = dict(zip(whole[2].tolist(), map(fold, words)))
    assert len(hashes) == len(set(map(fold, words)))


def test_scores_past_64_bits(spark):
    rows = [(9_000_000_000_000_000_000, 9_000_000_000_000_000_000, 9_100_000_000_000_000_001), (30, 31, 45), (1, 1, 1)]
    df = spark.createDataFrame(rows, "a long, l long, r long")
    got = [r[0] for r in df.select(collocations.cut_score(F.col("a"), F.col("l"), F.col("r"))).collect()]
    assert got == [2_000_000 * a // (l + r) for a, l, r in rows]
