"""Ranked lexical search over an index of posting lists whose blocks hold similar documents.

Per-term geometric blocking: documents are indexed in shards, each the work of one task. In a shard the posting list of a term is
clustered by the similarity of its documents, and each cluster (block) keeps the coordinatewise maximum of its documents' vectors.
A query's weights times that summary bound the score of every document in the block, so a block is skipped only if its
bound stays below the score that the query's last result must reach. What is not skipped is scored exactly.

Queries are taken in blocks of bounded size. The index of a block of queries covers all documents, but only the terms
that these queries use; a summary holds the terms that stand in a query together with the term of its list.
"""

from __future__ import annotations

import math
import os
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from marketlens import session

RESULTS = 10
QUERY_ITEMS, QUERY_TERMS = 256, 1 << 14  # a block of queries has at most so many items and terms (or one item)
SHARD_DOCS, SHARD_CELLS = 1024, 1 << 23  # documents of a shard; documents times terms
BLOCK_DOCS = 32
STEP = 3922  # summaries hold weights in steps of that size, rounded up, in one byte: 1,000,000 is 255 steps at most
SLICE = 1 << 20
_TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_BETWEEN = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
_VECTORS = "doc_id long, n long, terms array<int>, counts array<int>"
_INDEX = ("docs array<long>, starts binary, terms binary, weights binary, lists binary, sizes binary, members binary, "
          "summaries binary")


def count_terms(text: bytes) -> Counter:
    """How often each term occurs: runs of ASCII letters and digits and of all other characters beyond ASCII, A-Z lower-cased."""
    counts, i = Counter(), 0
    while i < len(text):
        end = _BETWEEN.search(text, i + SLICE)
        j = end.start() if end else len(text)
        counts.update(_TERM.findall(text[i:j].lower()))
        i = j
    return counts


def query_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """item_id and the different terms of each item."""
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [sorted(count_terms(t or b"")) for t in batch.column(1).cast(pa.large_binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(terms, pa.list_(pa.binary()))], names=["item_id", "terms"])
    rows = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(found, "item_id long, terms array<binary>")


def query_blocks(queries: DataFrame) -> Iterator[list[Row]]:
    """The queries in blocks that are small enough for every task; they come to the driver one partition at a time."""
    block, size = [], 0
    for row in queries.toLocalIterator():
        if block and (len(block) == QUERY_ITEMS or size + len(row["terms"]) > QUERY_TERMS):
            yield block
            block, size = [], 0
        block.append(row)
        size += len(row["terms"])
    if block:
        yield block


def term_vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, number of terms with repeats, and the terms of the vocabulary with their counts; documents without terms are left out."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value
        for batch in batches:
            texts, lo = batch.column(1).cast(pa.large_binary()), 0
            kept, sizes, terms, counts, ends = [], [], [], [], [0]
            for lo in range(len(texts)):
                found = count_terms(texts[lo].as_py())
                if not found:
                    continue
                hits = sorted((number[t], c) for t, c in found.items() if t in number)
                kept.append(lo)
                sizes.append(found.total())
                terms += [t for t, _ in hits]
                counts += [c for _, c in hits]
                ends.append(len(terms))
            of = lambda x: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(kept, pa.int64())), pa.array(sizes, pa.int64()),
                                              of(terms), of(counts)], names=["doc_id", "n", "terms", "counts"])
    return docs.mapInArrow(vectors, _VECTORS)


def term_weight(n_docs: int, df: int) -> int:
    """floor(1000 ln((2N + 2) / (2 df + 1)))."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _together(queries: list[np.ndarray], n_terms: int) -> list[np.ndarray]:
    """For each term the terms that stand in a query with it, itself included."""
    parts: list[list[np.ndarray]] = [[] for _ in range(n_terms)]
    for q in queries:
        for t in q:
            parts[t].append(q)
    return [np.unique(np.concatenate([np.empty(0, np.int64), *p])) for p in parts]


def _blocks_of(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of a posting list by cluster, and where each cluster begins: every row goes to the most similar of evenly spread ones."""
    if len(x) <= BLOCK_DOCS:
        return np.arange(len(x)), np.zeros(1, np.int64)
    x = x.astype(np.float32)
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    centres = x[np.linspace(0, len(x) - 1, -(-len(x) // BLOCK_DOCS)).astype(np.int64)]
    owner = (x @ centres.T).argmax(1)
    order = np.argsort(owner, kind="stable")
    return order, np.flatnonzero(np.diff(owner[order], prepend=-1))


def _shard(docs: pa.Array, starts: np.ndarray, terms: np.ndarray, weights: np.ndarray, n_terms: int,
           together: list[np.ndarray]) -> dict:
    """One row of the index."""
    rows = np.repeat(np.arange(len(docs)), np.diff(starts))
    dense = np.zeros((len(docs), n_terms), np.int32)
    dense[rows, terms] = weights
    order = np.argsort(terms, kind="stable")
    begins = np.flatnonzero(np.diff(terms[order], prepend=-1))
    size = np.diff(starts)
    lists, sizes, members, summaries = [], [], [], []
    for a, b in zip(begins, [*begins[1:], len(order)]):
        t, own = int(terms[order[a]]), rows[order[a:b]]
        # A summary that is larger than the vectors it stands for saves nothing: such a list is always looked through.
        if len(together[t]) > size[own].sum():
            by, cut, top = np.arange(b - a), np.zeros(1, np.int64), np.empty(0, np.int32)
        else:
            x = dense[np.ix_(own, together[t])]
            by, cut = _blocks_of(x)
            top = np.maximum.reduceat(x[by], cut)
        lists.append((t, len(cut), len(top)))
        sizes.append(np.diff(cut, append=b - a))
        members.append(own[by])
        summaries.append(((top + (STEP - 1)) // STEP).astype(np.uint8).ravel())
    pack = lambda x, kind: np.asarray(x, kind).tobytes()
    return {"docs": docs.to_pylist(), "starts": pack(starts, np.int32), "terms": pack(terms, np.int32),
            "weights": pack(weights, np.int32), "lists": pack(lists, np.int32), "sizes": pack(np.concatenate(sizes), np.int32),
            "members": pack(np.concatenate(members), np.int32), "summaries": pack(np.concatenate(summaries), np.uint8)}


def build_index(vectors: DataFrame, n_docs: int, n_words: int, n_terms: int, queries: list[np.ndarray]) -> DataFrame:
    """Shards of the documents that hold a term: their vectors, posting lists in blocks, summaries."""
    per_shard = max(1, min(SHARD_DOCS, SHARD_CELLS // max(n_terms, 1)))
    asked = vectors.sparkSession.sparkContext.broadcast(queries)
    schema = pa.schema([("docs", pa.list_(pa.int64())), *[(c, pa.binary()) for c in (
        "starts", "terms", "weights", "lists", "sizes", "members", "summaries")]])

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        together = _together(asked.value, n_terms)
        for batch in batches:
            for lo in range(0, batch.num_rows, per_shard):
                part = batch.slice(lo, per_shard)
                lengths = part.column(1).to_pylist()
                norm = np.array([10 + 90 * n * n_docs // n_words for n in lengths], np.int64)
                starts = part.column(2).offsets.to_numpy().astype(np.int64)
                starts = starts - starts[0]
                terms = part.column(2).flatten().to_numpy().astype(np.int64)
                counts = part.column(3).flatten().to_numpy().astype(np.int64)
                weights = 1_000_000_000 * counts // (1000 * counts + 8 * np.repeat(norm, np.diff(starts)))
                row = _shard(part.column(0), starts, terms, weights, n_terms, together)
                yield pa.RecordBatch.from_pylist([row], schema)
    return vectors.where(F.size("terms") > 0).mapInArrow(shards, _INDEX)


class _Best:
    """The first results of each query so far: score descending, then document ascending, documents without id last."""

    def __init__(self, n: int, results: int):
        self.results = results
        self.rows = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)) for _ in range(n)]

    def least(self, query: int) -> int:
        """Score that a further document must have at least."""
        scores = self.rows[query][0]
        return int(scores[-1]) if len(scores) == self.results else 1

    def add(self, query: int, scores: np.ndarray, docs: np.ndarray, missing: np.ndarray) -> None:
        """Take further documents in."""
        s, d, m = (np.concatenate(x) for x in zip(self.rows[query], (scores, docs, missing)))
        first = np.lexsort((d, m, -s))[:self.results]
        self.rows[query] = s[first], d[first], m[first]


def _search_shard(row: dict, queries: list[np.ndarray], weights: np.ndarray, places: list[dict[int, np.ndarray]],
                  least: list[int], best: _Best, n_terms: int, seeds_only: bool) -> None:
    """Take the results of one shard in. ``seeds_only``: each query looks at its block of the highest bound alone."""
    of = lambda name, kind=np.int32: np.frombuffer(row[name], kind)
    docs = row["docs"]
    missing = np.array([d is None for d in docs])
    ids = np.array([0 if d is None else d for d in docs], np.int64)
    dense = np.zeros((len(docs), n_terms), np.int32)
    dense[np.repeat(np.arange(len(docs)), np.diff(of("starts"))), of("terms")] = of("weights")
    highest = dense.max(0).astype(np.int64)
    lists, sizes, members, summaries = of("lists").reshape(-1, 3), of("sizes"), of("members"), of("summaries", np.uint8)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    at, block, byte = {}, 0, 0
    for t, n_blocks, n_tops in lists.tolist():
        width = len(places[t][-1])
        at[t] = block, block + n_blocks, summaries[byte:byte + n_tops * width].reshape(n_tops, width)
        block, byte = block + n_blocks, byte + n_tops * width
    for k, q in enumerate(queries):
        w, goal = weights[q], max(least[k], best.least(k))
        most = w * highest[q]
        by = np.argsort(most, kind="stable")
        # Terms that cannot reach the goal even together need no look: a document must hold one of the others.
        drivers = by[np.cumsum(most[by]) >= goal]
        wanted, top = np.zeros(len(docs), bool), (-1, None)
        for t in q[drivers].tolist():
            if t not in at:
                continue
            first, last, summary = at[t]
            bounds = (summary[:, places[t][k]].astype(np.int64) @ w) * STEP if len(summary) else np.array([most.sum()])
            if seeds_only:
                i = int(bounds.argmax())
                top = max(top, (int(bounds[i]), first + i), key=lambda x: x[0])
                continue
            for i in np.flatnonzero(bounds >= goal):
                wanted[members[ends[first + i]:ends[first + i + 1]]] = True
        if seeds_only and top[0] >= goal:
            wanted[members[ends[top[1]]:ends[top[1] + 1]]] = True
        found = np.flatnonzero(wanted)
        if len(found):
            scores = dense[np.ix_(found, q)].astype(np.int64) @ w
            good = scores >= goal
            best.add(k, scores[good], ids[found[good]], missing[found[good]])


def _scan(index: DataFrame, queries: list[np.ndarray], weights: np.ndarray, least: list[int], results: int,
          seeds_only: bool) -> DataFrame:
    """query, doc_id, score: the first results of each task for each query."""
    asked = index.sparkSession.sparkContext.broadcast((queries, weights, least))
    schema = pa.schema([("query", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights, least = asked.value
        together = _together(queries, len(weights))
        places: list[dict[int, np.ndarray]] = [{-1: x} for x in together]
        for k, q in enumerate(queries):
            for t in q.tolist():
                places[t][k] = np.searchsorted(together[t], q)
        best = _Best(len(queries), results)
        for batch in batches:
            for i in range(batch.num_rows):
                _search_shard(batch.slice(i, 1).to_pylist()[0], queries, weights, places, least, best, len(weights), seeds_only)
        for k, (scores, docs, missing) in enumerate(best.rows):
            if len(scores):
                yield pa.RecordBatch.from_arrays([pa.array([k] * len(scores), pa.int32()), pa.array(docs, mask=missing),
                                                  pa.array(scores)], schema=schema)
    return index.mapInArrow(scanned, "query int, doc_id long, score long")


def _first(found: DataFrame, results: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= results)


def _search_block(spark: SparkSession, docs: DataFrame, block: list[Row], path: str, results: int) -> DataFrame:
    vocabulary = {t: k for k, t in enumerate(sorted({bytes(t) for row in block for t in row["terms"]}))}
    queries = [np.array(sorted(vocabulary[bytes(t)] for t in row["terms"]), np.int64) for row in block]
    term_vectors(docs, vocabulary).write.parquet(os.path.join(path, "vectors"))
    vectors = spark.read.parquet(os.path.join(path, "vectors"))
    n_docs, n_words = vectors.agg(F.count("*"), F.sum("n")).first()
    held = vectors.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).toArrow().to_pydict()
    df = dict(zip(held["t"], held["df"]))
    weights = np.array([term_weight(n_docs, df.get(t, 0)) for t in range(len(vocabulary))], np.int64)
    build_index(vectors, n_docs, n_words or 1, len(vocabulary), queries).write.parquet(os.path.join(path, "index"))
    index = spark.read.parquet(os.path.join(path, "index"))
    seeds = _first(_scan(index, queries, weights, [1] * len(queries), results, seeds_only=True), results)
    goals = seeds.where(F.col("rank") == results).select("query", "score").toArrow().to_pydict()
    goal = dict(zip(goals["query"], goals["score"]))
    least = [goal.get(k, 1) for k in range(len(queries))]
    found = _first(_scan(index, queries, weights, least, results, seeds_only=False), results)
    names = spark.createDataFrame([(k, row["item_id"]) for k, row in enumerate(block)], "query int, item_id long")
    found.join(names, "query").select("item_id", "rank", "doc_id", "score").write.parquet(os.path.join(path, "found"))
    return spark.read.parquet(os.path.join(path, "found"))


def search(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text", results: int = RESULTS) -> DataFrame:
    """The ``results`` documents with the highest scores above 0 for each item: item_id, rank, doc_id, score.

    Terms are those of :func:`count_terms`. A term weighs :func:`term_weight`; a document of n of the N documents' L terms has
    m = 10 + (90 n N) div L and scores the sum, over the item's terms, of weight * ((1000000000 tf) div (1000 tf + 8 m)).
    Equal scores go by ascending doc_id, documents without id last. Null and empty texts have no terms and do not count
    among the N; every row is a document and every item row a query of its own; other columns are left out; items without
    terms, and empty tables, have no results.
    """
    spark = docs.sparkSession
    session.ship(spark)
    path = session.scratch(spark, "lexical-search")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    found = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for k, block in enumerate(query_blocks(query_terms(items, item_id, item_text))):
        found = found.unionByName(_search_block(spark, rows, block, os.path.join(path, f"block-{k}"), results))
    return found
