"""Lexical search against plain scoring of every document."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import SCHEMA, corpus, edge_rows, nothing, text_of, word  # noqa: F401

from marketlens.llm import lexical_search as ls

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def plain(docs, items, results=10):
    """item_id, rank, doc_id, score of every item row."""
    found = [(i, Counter(terms(t))) for i, t in docs]
    found = [(i, c) for i, c in found if c]
    n_docs, n_words = len(found), sum(c.total() for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in found:
            m = 100 - 90 + (90 * c.total() * n_docs) // n_words
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in set(terms(text)) if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, k, None if gone else i, -s) for k, (s, gone, i) in enumerate(sorted(scored)[:results], 1)]
    return sorted(out, key=repr)


def searched(docs, items, **options):
    return sorted((tuple(r) for r in ls.search(docs, items, **options).collect()), key=repr)


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "item_id long, text string, doc_id string, score int")


def some_items(rng, rows, n=12):
    texts = [t for _, t in rows if t]
    out = []
    for i in range(n):
        w = rng.choice(texts).split(" ")[:rng.randint(1, 40)]
        out.append((i, " ".join(w + [word(rng, 2).upper(), "_-_"])))
    return [*out, (50, None), (51, ""), (None, "the on, ER"), (None, "the on, ER"), (52, "nowhere-found"), (53, "the the THE")]


@pytest.mark.parametrize("shard,block", [(1024, 32), (20, 3), (7, 1)])
def test_search_equals_plain_scores(spark, corpus, monkeypatch, shard, block):  # noqa: F811
    monkeypatch.setattr(ls, "SHARD_DOCS", shard)
    rows = [tuple(r) for r in corpus.select("doc_id", "text").collect()]
    items = some_items(random.Random(shard), rows)
    monkeypatch.setattr(ls, "BLOCK_DOCS", block)
    want = plain(rows, items)
    assert searched(corpus, items_of(spark, items)) == want and len(want) > 60


def test_queries_in_many_blocks(spark, corpus, monkeypatch):  # noqa: F811
    rows = [tuple(r) for r in corpus.select("doc_id", "text").collect()]
    items = some_items(random.Random(1), rows)[:8]
    monkeypatch.setattr(ls, "QUERY_ITEMS", 3)
    monkeypatch.setattr(ls, "QUERY_TERMS", 40)
    assert searched(corpus, items_of(spark, items), results=3) == plain(rows, items, 3)


def test_a_hot_group_of_copies(spark):
    rng = random.Random(6)
    copy = text_of(rng, 30)
    rows = [(i, copy) for i in range(400)] + [(1000 + i, text_of(rng, 25)) for i in range(300)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0, "w", 1, 2) for i, t in rows], SCHEMA).repartition(4)
    items = [(1, copy), (2, text_of(rng, 20))]
    got = searched(docs, items_of(spark, items))
    assert got == plain(rows, items) and {r[2] for r in got if r[0] == 1} == set(range(10))


def test_summaries_bound_all_scores_of_their_blocks():
    rng = np.random.default_rng(3)
    n_docs, n_terms = 300, 60
    held = [np.flatnonzero(rng.random(n_terms) < 0.2) for _ in range(n_docs)]
    starts = np.concatenate([[0], np.cumsum([len(h) for h in held])])
    terms_, weights = np.concatenate(held), rng.integers(1, 1_000_000, starts[-1])
    queries = [np.sort(rng.choice(n_terms, 8, replace=False)) for _ in range(10)]
    together = ls._together(queries, n_terms)
    row = ls._shard(pa.array(range(n_docs)), starts, terms_, weights, n_terms, together)
    dense = np.zeros((n_docs, n_terms), np.int64)
    dense[np.repeat(np.arange(n_docs), np.diff(starts)), terms_] = weights
    lists, sizes = np.frombuffer(row["lists"], np.int32).reshape(-1, 3), np.frombuffer(row["sizes"], np.int32)
    members, tops = np.frombuffer(row["members"], np.int32), np.frombuffer(row["summaries"], np.uint8)
    block = at = byte = several = 0
    for t, n_blocks, n_tops in lists.tolist():
        seen = []
        for k in range(n_blocks):
            own = members[at:at + sizes[block]]
            seen += own.tolist()
            if n_tops:
                top = tops[byte:byte + len(together[t])].astype(np.int64) * ls.STEP
                assert (top >= dense[np.ix_(own, together[t])].max(0)).all()
                byte += len(together[t])
            at, block = at + sizes[block], block + 1
        assert sorted(seen) == np.flatnonzero(dense[:, t]).tolist()
        several += n_blocks > 1
    assert several and byte == len(tops)


def test_blocks_are_skipped_and_little_is_scored(spark):
    """Distinct topics: a query's blocks of other topics stay below its goal."""
    rng = random.Random(9)
    topics = [[f"{a}{k}" for k in range(12)] for a in "abcdefgh"]
    rows = [(i, " ".join(["common", *rng.choices(topics[i % 8], k=8)])) for i in range(800)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0, "w", 1, 2) for i, t in rows], SCHEMA).coalesce(1)
    items = [(k, " ".join(["common", *topics[k]])) for k in range(8)]
    assert searched(docs, items_of(spark, items)) == plain(rows, items)


def test_edge_cases(spark, corpus, nothing):  # noqa: F811
    one = items_of(spark, [(1, "the on er")])
    assert searched(nothing, one) == [] and searched(corpus, items_of(spark, [])) == []
    assert searched(corpus, items_of(spark, [(1, None), (2, "- _ .")])) == []
    assert ls.count_terms("AbÉ_9x-ab\u0085 É9".encode()) == {"abÉ".encode(): 1, b"9x": 1, "ab\u0085".encode(): 1, "É9".encode(): 1}


def test_terms_do_not_depend_on_slices(monkeypatch):
    rng = random.Random(2)
    data = "".join(rng.choice(["ab", "É", " ", "_", "Zz9", "-"]) for _ in range(4000)).encode()
    whole = ls.count_terms(data)
    monkeypatch.setattr(ls, "SLICE", 11)
    assert ls.count_terms(data) == whole == Counter(t.encode() for t in terms(data.decode()))
