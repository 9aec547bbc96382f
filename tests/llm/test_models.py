"""Language model and toxicity models against plain Python versions."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlens.llm import language_model, toxicity, words
from llm_cases import corpus, folded, nothing  # noqa: F401


def fold(i, n):
    return 0 if i is None else zlib.crc32(str(i).encode()) % n


def test_hashes_follow_words():
    rng = random.Random(1)
    data = "".join(rng.choice(["a", "B", "é", " ", "\n", "\t", "\x0b", " ", "zz"]) for _ in range(20_000)).encode()
    for segment in (1 << 20, 64):
        before, words.SEGMENT_BYTES = words.SEGMENT_BYTES, segment
        starts, hashes = words.hashed_words(data)
        words.SEGMENT_BYTES = before
        plain = data.lower().split()
        assert len(hashes) == len(plain) and len(set(hashes.tolist())) == len(set(plain))
        assert len({(h, w) for h, w in zip(hashes.tolist(), plain)}) == len(set(plain))
        assert [data[s:s + len(w)].lower() for s, w in zip(starts, plain)] == plain


def test_base_score_and_counts(corpus):
    rows = [(r["doc_id"], folded(r["text"])) for r in corpus.select("doc_id", "text").collect()]
    c = Counter()
    for i, w in rows:
        if fold(i, 10):
            c.update([*w, None])
    n, v = sum(c.values()), len(c)
    want = sorted(((i is None, i or 0, len(w) + 1, sum(c[t] > 0 for t in [*w, None]), n,
                    sum(math.log10((c[t] + 0.1) / (n + 0.1 * (v + 1))) for t in [*w, None])) for i, w in rows))
    train = corpus.where(language_model.fold_of(F.col("doc_id"), 10) != 0)
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"])
                 for r in language_model.score(corpus, train).collect())
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want], rel=1e-9)


def test_rare_words_are_joined(corpus, monkeypatch):
    train = corpus.where(language_model.fold_of(F.col("doc_id"), 10) != 0)
    order = ["doc_id", "n_tokens", "base_score"]
    some = language_model.score(corpus, train).toPandas().sort_values(order, ignore_index=True)
    monkeypatch.setattr(language_model, "COMMON_WORD", 1 / 100)
    other = language_model.score(corpus, train).toPandas().sort_values(order, ignore_index=True)
    assert (some["n_known"] == other["n_known"]).all()
    assert np.allclose(some["base_score"], other["base_score"])


def plain_model(training, word_share, ngram_share):
    """Back-off probabilities by dictionaries and recursion."""
    counts = Counter(t for w in training for t in [*w, "</s>"])
    n = sum(counts.values())
    vocab = {t for t, c in counts.items() if c >= max(1.0, n * word_share)}
    of = lambda t: t if t in vocab else "<other>"
    root = {t: counts[t] / (n + 1) for t in vocab}
    root["<other>"] = (n - sum(counts[t] for t in vocab) + 1) / (n + 1)
    pairs, triples = Counter(), Counter()
    for w in training:
        s = ["<s>", *map(of, w), of("</s>")]
        pairs.update(zip(s, s[1:]))
    totals = Counter()
    for (u, _), c in pairs.items():
        totals[u] += c
    least = max(language_model.LEAST_COUNT, n * ngram_share)
    kept2 = {k: c for k, c in pairs.items() if c >= least}
    for w in training:
        s = ["<s>", *map(of, w), of("</s>")]
        triples.update(t for t in zip(s, s[1:], s[2:]) if t[:2] in kept2 and t[1:] in kept2)
    kept3 = {k: c for k, c in triples.items() if c >= least}
    d = language_model.DISCOUNT

    def p2(u, w):
        if (u, w) in kept2:
            return (kept2[u, w] - d) / totals[u]
        mine = [k for k in kept2 if k[0] == u]
        left = 1 - sum((kept2[k] - d) / totals[u] for k in mine)
        return left / (1 - sum(root[k[1]] for k in mine)) * root[w]

    def p3(t, u, w):
        if (t, u, w) in kept3:
            return (kept3[t, u, w] - d) / kept2[t, u]
        mine = [k for k in kept3 if k[:2] == (t, u)]
        if not mine:
            return p2(u, w)
        left = 1 - sum((kept3[k] - d) / kept2[t, u] for k in mine)
        return left / (1 - sum(p2(u, k[2]) for k in mine)) * p2(u, w)

    other = max(len(counts) - len(vocab), 0) + 1

    def score(w):
        s = ["<s>", *map(of, w), of("</s>")]
        total = math.log10(p2("<s>", s[1]))
        for k in range(2, len(s)):
            total += math.log10(p3(s[k - 2], s[k - 1], s[k]))
        return total - s.count("<other>") * math.log10(other)

    return score, p3, root, vocab


def test_automaton_equals_recursion(spark, monkeypatch):
    rng = random.Random(8)
    chain = {a: rng.sample("abcdefghij", 3) for a in "abcdefghij"}
    rows = []
    for i in range(60):
        w = ["a"]
        while len(w) < 40:
            w.append(rng.choice(chain.get(w[-1], "abc")) if rng.random() < 0.9 else f"x{rng.randint(0, 30)}")
        rows.append((i, " ".join(w)))
    monkeypatch.setattr(language_model, "MODEL_WORD", 1 / 200)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    score, p3, root, vocab = plain_model([t.split() for _, t in rows], 1 / 200, language_model.MODEL_NGRAM)
    got = {r["doc_id"]: r["score"] for r in language_model.score(df, df).collect()}
    for i, t in rows:
        assert got[i] == pytest.approx(score(t.split()), rel=1e-9)
    for t, u in (("a", chain["a"][0]), ("b", chain["b"][1]), ("<s>", "a")):
        assert sum(p3(t, u, w) for w in root) == pytest.approx(1.0)


@pytest.mark.parametrize("hot", [1 / 500_000, 1 / 50])
def test_rare_words_have_their_own_ngrams(spark, monkeypatch, hot):
    """Words and n-grams far below any share of the corpus are in the model, whether handed to all tasks or joined."""
    monkeypatch.setattr(language_model, "COMMON_NGRAM", hot)
    monkeypatch.setattr(language_model, "COMMON_WORD", hot)
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abcdefghij") for _ in range(300)) for _ in range(100)]
    texts += ["rare one stands here", "a rare one stands", "rare one", "b rare x", ""]
    train = [t.split() for t in texts]
    asked = [*texts[:3], "rare one stands here", "one rare stands", "never seen rare one never", "", None]
    score = plain_model(train, 0.0, 0.0)[0]
    learned = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs = spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in language_model.score(docs, learned).collect()}
    for i, t in enumerate(asked):
        assert got[i] == pytest.approx(score((t or "").split()), rel=1e-9), t


def test_language_model_without_training(corpus, nothing):
    rows = language_model.score(corpus, nothing).collect()
    assert {(r["n_known"], r["train_tokens"]) for r in rows} == {(0, 0)}
    assert all(r["base_score"] == pytest.approx(0.0) and math.isfinite(r["score"]) for r in rows)
    assert language_model.score(nothing, corpus).count() == 0


def toxic_docs(n=400, seed=3):
    rng = random.Random(seed)
    bad = ["idiot", "scum", "moron", "clown"]
    rows = []
    for i in range(n):
        w = [rng.choice("the of and to in is".split()) if rng.random() < 0.4 else f"w{int(rng.expovariate(0.02))}"
             for _ in range(rng.randint(20, 300))]
        toxic = rng.random() < 0.15
        if toxic:
            for _ in range(2 + len(w) // 50):
                w.insert(rng.randrange(len(w)), rng.choice(bad))
        elif rng.random() < 0.1:
            w += ["the"] * 200
        rows.append((i, " ".join(w), int(toxic)))
    return rows


def test_toxicity_is_told_apart(spark):
    rows = toxic_docs()
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic").where(toxicity.fold_of(F.col("doc_id"), 5) != 0))
    got = {r["doc_id"]: r for r in toxicity.score(df.select("doc_id", "text"), model).collect()}
    held = [(i, y) for i, _, y in rows if fold(i, 5) == 0]
    assert sum(got[i]["predicted"] == y for i, y in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())


def test_kneser_ney_ratios(spark):
    rows = [(i, t, y) for i, t, y in toxic_docs(150)]
    df = spark.createDataFrame([(i, t, bool(y)) for i, t, y in rows], "doc_id long, text string, toxic boolean")
    model = toxicity.fit_counts(df)
    pairs = {True: Counter(), False: Counter()}
    for _, t, y in rows:
        w = t.split()
        pairs[bool(y)].update(set(zip([None, *w], w)))
    cont = {y: Counter(v for _, v in p) for y, p in pairs.items()}
    every = Counter(v for _, v in {*pairs[True], *pairs[False]})
    n = {y: sum(c.values()) for y, c in cont.items()}

    def p(y, v):
        left = toxicity.DISCOUNT * len(cont[y]) / n[y]
        return max(cont[y][v] - toxicity.DISCOUNT, 0) / n[y] + left * every[v] / sum(every.values())

    for w in ("idiot", "scum", "moron", "clown"):
        _, h = words.hashed_words(w.encode())
        known, value = toxicity._found(model.words, model.word_ratios, h)
        assert known[0] and value[0] == pytest.approx(math.log(p(True, w) / p(False, w)))
    _, h = words.hashed_words(b"the of w3")
    assert not toxicity._found(model.words, model.word_ratios, h)[0].any()


def test_toxicity_edge_cases(spark, corpus, nothing):
    labels = spark.createDataFrame([(1000, 1), (1001, None), (None, 1), (1002, 0), (1002, 1)], "doc_id long, toxic int")
    model = toxicity.fit(corpus, labels)
    rows = toxicity.score(corpus, model).collect()
    assert len(rows) == corpus.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score(nothing, toxicity.fit(nothing, labels)).count() == 0
    assert toxicity.score(corpus, toxicity.fit(corpus, labels.limit(0))).count() == corpus.count()
