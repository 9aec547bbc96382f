"""Benchmark decontamination by spaced seeds.

A mask over a few neighbouring words says which of them count; words at the other places may differ. Hashes of the
benchmark items under all masks are joined with those of the documents, and around each hit the two texts are
compared word by word. A fixed-size Bloom filter of the items' hashes keeps all other places out of the shuffle.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens import session
from marketlens.llm import bloom, words

#: Fixed masks: 1 counts, 0 may differ. Each passage of 8 to ``WINDOW`` words with ``MIN_EQUAL_PERCENT`` equal has one of the first.
MASKS = ("1101011", "1011101", "1110111", "1110011", "1100111", "1011011")
#: By the words of a shorter item: it is looked for as a whole, in stretches that leave out or pass over the word that may differ.
SHORT_MASKS = {5: ("1111", "11011", "11101", "10111"), 6: ("11111", "111101", "111011", "110111", "101111"), 7: ("111111",)}
SPAN = 7
WINDOW = 10  # words that are compared around a hit
MIN_EQUAL_PERCENT = 80
MIN_ITEM_WORDS = 5
_REGION = "doc_id long, text_hash long, at int, words array<long>, seeds array<struct<seed:long,pos:int>>"


def _seeds(hashes: np.ndarray, masks: tuple[str, ...]) -> Iterator[tuple[str, np.ndarray]]:
    """Each mask and its hashes at all places of a sequence of word hashes (row borders are not looked at)."""
    for number, mask in enumerate(masks):
        n = len(hashes) - len(mask) + 1
        if n <= 0:
            continue
        h = np.full(n, (number + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1, np.uint64)
        for k, bit in enumerate(mask):
            if bit == "1":
                h = words.mix(h ^ hashes[k:k + n]) + np.uint64(k)
        yield mask, h


def _all_masks(short: list[int]) -> tuple[str, ...]:
    return (*MASKS, *dict.fromkeys(m for n in short for m in SHORT_MASKS[n]))


def _of_item(size: int) -> frozenset[str]:
    """Masks that an item of that many words is looked for by."""
    return frozenset((*(MASKS if size >= SPAN else ()), *SHORT_MASKS.get(size, ())))


def _items(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    """Word hashes of the different items: item_id (the smallest of those with the same words; null if all are), words, item
    (a key that is never null)."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, h, first in words.blocks(batch):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), words.ragged(first, h.view(np.int64), pa.int64())],
                    names=["item_id", "words"])
    rows = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).cast("string").alias("text"))
    return (rows.mapInArrow(hashed, "item_id long, words array<long>").where(F.size("words") >= MIN_ITEM_WORDS)
            .groupBy("words").agg(F.min("item_id").alias("item_id")).withColumn("item", F.xxhash64("words")))


def find(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
         item_text: str = "text") -> DataFrame:
    """Pairs of a document and a benchmark item it holds a passage of: doc_id, text_hash, item_id, n_equal, n_compared,
    doc_word, item_word.

    A passage is a stretch of ``WINDOW`` words (or a whole shorter item) of which ``MIN_EQUAL_PERCENT`` are equal place by
    place, A-Z lower-cased; the best stretch of a pair is shown (most equal words, then the first in the document), by its
    first words. Items of fewer than ``MIN_ITEM_WORDS`` words are not searched for; of items with the same words
    the smallest id stands for all. Null texts have no words; null ids are kept; repeated rows count once; other columns
    are left out; without documents or items there are no rows.
    """
    spark = docs.sparkSession
    session.ship(spark)
    path = session.scratch(spark, "decontaminate")
    _items(benchmark, item_id, item_text).write.parquet(os.path.join(path, "items"))
    items = spark.read.parquet(os.path.join(path, "items"))
    short = sorted(r[0] for r in items.where(F.size("words") <= SPAN).select(F.size("words")).distinct().collect())
    masks = _all_masks(short)  # items of at most that many words are looked for as a whole

    def item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seeds, owners, places = [], [], []
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                for mask, h in _seeds(np.array(value.values).astype(np.int64).view(np.uint64), masks):
                    if mask in _of_item(len(value)):
                        seeds.append(h)
                        owners += [key] * len(h)
                        places.append(np.arange(len(h), dtype=np.int32))
            if seeds:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(seeds).view(np.int64)), pa.array(owners, pa.int64()),
                                                  pa.array(np.concatenate(places))], names=["seed", "item", "item_pos"])

    (items.select("item", "words").mapInArrow(item_seeds, "seed long, item long, item_pos int")
     .write.parquet(os.path.join(path, "seeds")))
    known = spark.read.parquet(os.path.join(path, "seeds"))
    packed = spark.sparkContext.broadcast(
        bloom.build(known.select("seed"), lambda batch: batch.column(0).to_numpy().view(np.uint64)))

    def regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maybe = bloom.reader(packed.value)
        for batch in batches:
            for lo, _, h, first in words.blocks(batch):
                rows = np.repeat(np.arange(len(first) - 1), np.diff(first))
                found, places = [], []
                for mask, s in _seeds(h, masks):
                    hit = np.flatnonzero(maybe(s))
                    hit = hit[rows[hit] == rows[hit + len(mask) - 1]]
                    found.append(s[hit])
                    places.append(hit)
                if not found or not sum(map(len, places)):
                    continue
                seeds, at = np.concatenate(found), np.concatenate(places)
                order = np.argsort(at, kind="stable")
                seeds, at = seeds[order], at[order]
                begin, end = first[rows[at]], first[rows[at] + 1]
                left, right = np.maximum(at - WINDOW, begin), np.minimum(at + SPAN + WINDOW, end)
                cut = np.flatnonzero((left[1:] > right[:-1]) | (rows[at][1:] != rows[at][:-1])) + 1
                heads, tails = np.concatenate([[0], cut]), np.concatenate([cut, [len(at)]])
                keys = rows[at[heads]]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(lo + keys)), batch.column(2).take(pa.array(lo + keys)),
                    pa.array((left[heads] - first[keys]).astype(np.int32)),
                    pa.array([h[left[a]:right[b - 1]].view(np.int64) for a, b in zip(heads, tails)], pa.list_(pa.int64())),
                    pa.array([[{"seed": int(s), "pos": int(p)} for s, p in zip(
                        seeds[a:b].view(np.int64), at[a:b] - left[a])] for a, b in zip(heads, tails)],
                        pa.list_(pa.struct([("seed", pa.int64()), ("pos", pa.int32())])))],
                    names=["doc_id", "text_hash", "at", "words", "seeds"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
                       F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"))
    rows.mapInArrow(regions, _REGION).write.parquet(os.path.join(path, "regions"))
    places = spark.read.parquet(os.path.join(path, "regions")).dropDuplicates(["doc_id", "text_hash", "at"])
    places = places.withColumn("region", F.xxhash64("doc_id", "text_hash", "at"))
    hits = places.select("region", "text_hash", "at", F.explode("seeds").alias("s")).select("region", "text_hash", "at", "s.*")
    pairs = (hits.join(known, "seed")
             .select("region", "text_hash", "at", "item", (F.col("pos") - F.col("item_pos")).alias("shift")).distinct())
    compared = (pairs.join(places.select("doc_id", "region", "text_hash", "at", F.col("words").alias("doc_words")),
                           ["region", "text_hash", "at"])
                .join(items.select("item", "item_id", F.col("words").alias("item_words")), "item")
                .select("doc_id", "text_hash", "at", "item_id", "shift", "doc_words", "item_words"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, rows = [], []
            for i, (at, shift, d, m) in enumerate(zip(batch.column(2).to_pylist(), batch.column(4).to_pylist(),
                                                      batch.column(5), batch.column(6))):
                doc, item = (np.array(x.values, dtype=np.int64) for x in (d, m))
                lo, hi = max(0, shift), min(len(doc), shift + len(item))
                size = min(WINDOW, len(item))
                if hi - lo < size:
                    continue
                equal = np.concatenate([[0], np.cumsum(doc[lo:hi] == item[lo - shift:hi - shift])])
                sums = equal[size:] - equal[:-size]
                best = int(np.argmax(sums))
                if 100 * int(sums[best]) >= MIN_EQUAL_PERCENT * size:
                    kept.append(i)
                    rows.append((int(sums[best]), size, at + lo + best, lo - shift + best))
            of = lambda k: pa.array([r[k] for r in rows], pa.int64())
            at = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), batch.column(3).take(at), of(0), of(1), of(2), of(3)],
                names=["doc_id", "text_hash", "item_id", "n_equal", "n_compared", "doc_word", "item_word"])

    found = compared.mapInArrow(verify, "doc_id long, text_hash long, item_id long, n_equal long, n_compared long, "
                                        "doc_word long, item_word long")
    best = F.max_by(F.struct("n_equal", "n_compared", "doc_word", "item_word"),
                    F.struct("n_equal", -F.col("doc_word"), -F.col("item_word")))
    return found.groupBy("doc_id", "text_hash", "item_id").agg(best.alias("b")).select("doc_id", "text_hash", "item_id", "b.*")


def remove(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` but the documents that hold a passage of an item; see :func:`find`."""
    found = find(docs, benchmark, doc_id=doc_id, text=text, item_id=item_id, item_text=item_text)
    bad = found.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    hashed = F.xxhash64(F.coalesce(docs[text], F.lit("")))
    return docs.join(bad, docs[doc_id].cast("long").eqNullSafe(bad["__id"]) & (hashed == bad["__hash"]), "left_anti")
