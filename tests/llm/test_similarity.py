"""Jaccard join, components and decontamination against brute force, and the whole pipeline."""

from __future__ import annotations

import itertools
import random
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marketlens.llm import decontaminate, jaccard_join, line_dedup, packing, quality
from marketlens.llm.components import components
from llm_cases import corpus, folded, nothing, text_of, word  # noqa: F401

NULL = -(1 << 63)


def shingle_set(text, n):
    w = folded(text)
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def groups(rows, n, percent):
    """Smallest id of each row's component by comparing all pairs."""
    sets = [shingle_set(t, n) for _, t in rows]
    ids = [NULL if i is None else i for i, _ in rows]
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)):
                k = len(x & y)
                if 100 * k >= percent * (len(x) + len(y) - k):
                    label[root(a)] = root(b)
    low = {}
    for k, i in enumerate(ids):
        low[root(k)] = min(low.get(root(k), i), i)
    return Counter((i, len(sets[k]), low[root(k)]) for k, i in enumerate(ids))


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80), (1, 60)])
def test_jaccard_groups(corpus, n, percent):
    rows = [(r["doc_id"], r["text"]) for r in corpus.select("doc_id", "text").collect()]
    got = jaccard_join.link(corpus, shingle=n, percent=percent).collect()
    assert Counter((r["doc"], r["n_shingles"], r["first_doc"]) for r in got) == groups(rows, n, percent)


def test_chains_of_near_copies(spark):
    rng = random.Random(6)
    w, rows = [word(rng, 3) + str(k) for k in range(60)], []
    for i in range(150):
        w = list(w)
        w[rng.randrange(60)] = f"new{i}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join([*rows[0][1].split()[:20], *[f"own{i}x{k}" for k in range(40)]])) for i in range(40)]
    got = jaccard_join.link(spark.createDataFrame(rows, "doc_id long, text string"), shingle=3, percent=80).collect()
    assert Counter((r["doc"], r["n_shingles"], r["first_doc"]) for r in got) == groups(rows, 3, 80)


def test_group_of_near_copies_is_compared_as_a_whole(spark, monkeypatch, tmp_path):
    """Groups of many classes that share prefix elements across components make a row per group and element, not per class."""
    monkeypatch.setattr(jaccard_join.session, "scratch", lambda _, label: str(tmp_path / label))
    many = [" ".join(f"c{k}" for k in some) for some in itertools.combinations(range(10), 3)][::2]
    rows = [(1000 * g + i, " ".join([*[f"u{(20 * g + k) % 60}" for k in range(40)], tail])) for g in range(3) for i, tail in enumerate(many)]
    rows += [(9000 + i, " ".join(f"c{k}" for k in range(10))) for i in range(300)]
    got = jaccard_join.link(spark.createDataFrame(rows, "doc_id long, text string"), shingle=1, percent=80).collect()
    assert Counter((r["doc"], r["n_shingles"], r["first_doc"]) for r in got) == groups(rows, 1, 80)
    open_ = spark.read.parquet(str(tmp_path / "jaccard" / "open"))
    assert 0 < open_.count() <= 3 * open_.select("token").distinct().count()


def test_one_of_each_group_stays(corpus, nothing):
    kept = jaccard_join.deduplicate(corpus)
    assert kept.columns == corpus.columns
    rows = [(r["doc_id"], r["text"]) for r in corpus.select("doc_id", "text").collect()]
    want = {low for (_, n, low) in groups(rows, 5, 80) if n}
    ids = Counter(NULL if r["doc_id"] is None else r["doc_id"] for r in kept.collect())
    assert want <= set(ids)
    assert max(Counter((r["doc_id"], r["text"]) for r in kept.select("doc_id", "text").collect()).values()) == 1
    assert jaccard_join.link(nothing).count() == 0
    assert jaccard_join.deduplicate(nothing).columns == nothing.columns


def test_prefix_is_enough():
    for percent in (60, 80, 90):
        for n in range(1, 200):
            k = jaccard_join.prefix_size(n, percent)
            assert k == n - -(-percent * n // 100) + 1 and 1 <= k <= n


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100 + rng.randrange(60), 100 + rng.randrange(60)) for _ in range(40)]
    low = {x: x for e in edges for x in e}
    for _ in range(100):
        for a, b in edges:
            low[a] = low[b] = min(low[a], low[b])
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == low
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def overlap(doc, item):
    """Best stretch of a document and an item by trying all places."""
    best, size = None, min(decontaminate.WINDOW, len(item))
    for a in range(len(doc) - size + 1):
        for b in range(len(item) - size + 1):
            n = sum(x == y for x, y in zip(doc[a:a + size], item[b:b + size]))
            if 100 * n >= decontaminate.MIN_EQUAL_PERCENT * size and (best is None or n > best):
                best = n
    return best


def test_decontamination(spark, corpus, nothing):
    rng = random.Random(9)
    items = [(k, text_of(rng, n) + f" item{k}") for k, n in enumerate([30, 18, 25, 12, 6, 40, 2])]
    items += [(7, items[0][1].upper()), (8, None), (9, ""), (None, text_of(rng, 20))]
    docs = []
    for i in range(60):
        w = text_of(rng, 60).split(" ")
        if i % 3 == 0:
            passage = items[i % 6][1].split(" ")
            if i % 2:
                for k in range(4, len(passage), 9):
                    passage[k] = "other"
            w[20:20] = passage
        docs.append((i, "\n".join([" ".join(w[:30]), " ".join(w[30:])])))
    docs += [(100, None), (101, ""), (None, items[1][1]), (0, docs[0][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r["n_equal"] for r in decontaminate.find(df, bench).collect()}
    for i, t in dict(docs).items():
        for k, item in items[:6]:
            best = overlap(folded(t), folded(item))
            if i is not None and i % 3 == 0 and i < 60 and k == i % 6:
                assert best is not None
            assert found.get((i, k)) == best or best is not None and best < 10 and found.get((i, k)) is None, (i, k)
    assert all((i, i % 6) in found for i in range(0, 60, 3)) and (None, 1) in found
    assert not {k for _, k in found} & {6, 7, 8, 9}
    clean = decontaminate.remove(df, bench)
    assert {r["doc_id"] for r in clean.collect()} == {i for i, _ in docs if i is not None and (i % 3 or i >= 100)}
    assert decontaminate.find(nothing, bench).count() == 0 and decontaminate.find(df, bench.limit(0)).count() == 0
    assert decontaminate.remove(corpus, bench).columns == corpus.columns


def test_every_passage_is_found(spark):
    """Each way to change as many words of a passage as the definition allows; short items; items without an id."""
    items = {n: [f"i{n}w{k}" for k in range(n)] for n in (5, 6, 7, 8, 9, 10)}
    bench = [(n, " ".join(w)) for n, w in items.items()] + [(None, "an item that has no id and yet is sought")]
    docs, want = [], set()
    for n, w in items.items():
        free = n - -(-decontaminate.MIN_EQUAL_PERCENT * n // 100)
        for changed in itertools.combinations(range(n), free):
            passage = ["x" if k in changed else v for k, v in enumerate(w)]
            assert overlap(passage, w) == n - free
            want.add((len(docs), n))
            docs.append((len(docs), " ".join(["before", *passage, "behind"])))
        docs.append((len(docs), " ".join(["before", *["x" if k <= free else v for k, v in enumerate(w)], "behind"])))
    want.add((len(docs), None))
    docs.append((len(docs), "here is an item that has no id and yet is sought"))
    found = decontaminate.find(spark.createDataFrame(docs, "doc_id long, text string"),
                               spark.createDataFrame(bench, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == want


def test_masks_leave_no_passage_out():
    """Each way to change as many words of a passage as the definition allows leaves a seed."""
    for n in range(decontaminate.MIN_ITEM_WORDS, decontaminate.WINDOW + 1):
        masks = decontaminate._of_item(n)
        for changed in itertools.combinations(range(n), n - -(-decontaminate.MIN_EQUAL_PERCENT * n // 100)):
            assert any(all(bit == "0" or a + k not in changed for k, bit in enumerate(m))
                       for m in masks for a in range(n - len(m) + 1)), (n, changed)


def test_pipeline_stages(spark, corpus, nothing, tmp_path):
    bench = spark.createDataFrame([(1, "no such passage stands in any of the texts at all here")], "item_id long, text string")
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    corpus.write.parquet(str(tmp_path / "documents.parquet"))
    docs = corpus
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "best-fit packing"]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out, none = stage(spark, docs, str(tmp_path)), stage(spark, nothing, str(tmp_path))
        assert none.count() == 0
        if k < 4:
            assert out.columns == none.columns == corpus.columns
            out.write.parquet(str(tmp_path / f"stage-{k}"))
            docs = spark.read.parquet(str(tmp_path / f"stage-{k}"))
            assert docs.where(F.col("n_chars") != F.length("text")).count() == 0
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in docs.collect()}
    kept = quality.keep(corpus)
    lines = line_dedup.apply_bitmaps(kept, line_dedup.keep_bitmaps(kept)).drop("n_dropped")
    last = decontaminate.remove(jaccard_join.deduplicate(lines), bench)
    again = packing.pack(last, public_tokenizers.path("byte_bpe_50k.json"), 2, spaced=True).collect()
    assert Counter(r["length"] for r in rows) == Counter(r["length"] for r in again)
