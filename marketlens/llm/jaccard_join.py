"""Set-similarity join of documents on word shingles by grouped prefixes.

Two sets with a Jaccard similarity of at least t share one of the first ``n - ceil(t n) + 1`` elements of each, in any order
that is the same for all sets; the order here puts shingles first whose hash bucket is seldom used. Documents with the
same set are one class; classes with the same prefix and size are one group, and only groups are paired. A prefix
element that several groups share first pairs each of them with one pivot, and a group with its ``PIVOTS`` most frequent pivots;
verified pairs are joined to components. Then all groups that share an element and do not lie in one component are compared
as a whole: where the element stands and a sketch of the sets tell most that are not similar. All pairs of classes
in different components of what is left are verified, so no link between components is lost, while a large group of near
copies costs no more than ``PIVOTS`` pairs per member.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens import session
from marketlens.llm import bloom, words
from marketlens.llm.components import components

BUCKET_BITS = 18
SET_ROWS = 500  # rows whose sets are in a task's memory at a time
_NULL_ID = -(1 << 63)  # stands for a null id
_SET = ["n", "f1", "f2"]
SKETCH = 16  # longs of a set's sketch: a bit is set if an element has that place
PIVOTS = 2  # pivots a group is compared with at first


def _bucket_counts(rows: DataFrame, shingle: int) -> np.ndarray:
    """How many documents' shingles fall into each hash bucket: an array of fixed size."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in batches:
            for _, _, h, first in words.blocks(batch):
                keys, _ = words.shingles(h, first, shingle)
                total += np.bincount((keys >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), minlength=len(total))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["bucket", "n"])

    counts = np.zeros(1 << BUCKET_BITS, np.int64)
    found = rows.mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return counts


def _levels(counts: np.ndarray) -> np.ndarray:
    """Order of the buckets by use, in steps of a ninth, as the top byte of an element."""
    return np.minimum(8 * np.log2(np.maximum(counts, 1)), 255).astype(np.uint64) << np.uint64(56)


def _sets(batch: pa.RecordBatch, levels: np.ndarray, shingle: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and sorted elements (level, then hash) of each row's set."""
    for lo, hi, h, first in words.blocks(batch):
        keys, owner = words.shingles(h, first, shingle)
        elements = levels[(keys >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)] | words.mix(keys) >> np.uint64(8)
        cuts = np.searchsorted(owner, np.arange(hi - lo + 1))
        for r in range(hi - lo):
            yield lo + r, np.unique(elements[cuts[r]:cuts[r + 1]])


def prefix_size(n: int, percent: int) -> int:
    """Elements of which a set of ``n`` shares one with every set that is similar to it."""
    return n - -(-percent * n // 100) + 1


def _profiles(rows: DataFrame, levels: np.ndarray, shingle: int, percent: int) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(levels)

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, f1, f2, g, prefixes, sketches = [], [], [], [], [], []
            for _, s in _sets(batch, shared.value, shingle):
                k = prefix_size(len(s), percent) if len(s) else 0
                marks = words.mix(s)
                n.append(len(s))
                f1.append(int(marks.sum()))
                f2.append(int(words.mix(marks ^ np.uint64(0x5851F42D4C957F2D)).sum()))
                g.append(int(words.mix(marks[:k].sum(keepdims=True) + np.uint64(len(s)))[0]))
                prefixes.append(s[:k].view(np.int64))
                places = np.zeros(64 * SKETCH, bool)
                places[(marks % np.uint64(64 * SKETCH)).astype(np.int64)] = True
                sketches.append(np.packbits(places, bitorder="little").view("<i8"))
            as_long = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])])
            flat = np.concatenate(prefixes) if prefixes else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int32()), as_long(f1), as_long(f2), as_long(g),
                 words.ragged(offsets, flat, pa.int64()),
                 words.ragged(np.arange(len(n) + 1) * SKETCH, np.concatenate([*sketches, np.empty(0, np.int64)]), pa.int64())],
                names=["doc", "text_hash", *_SET, "gid", "prefix", "sketch"])

    return rows.mapInArrow(profile, "doc long, text_hash long, n int, f1 long, f2 long, gid long, prefix array<long>, "
                                    "sketch array<long>")


def _missing(x: str, y: str) -> Column:
    """Elements that are in the set of sketch ``x`` and surely not in that of ``y``; at least so many."""
    return sum((F.bit_count(F.get(x, F.lit(i)).bitwiseAND(F.bitwise_not(F.get(y, F.lit(i))))) for i in range(SKETCH)), F.lit(0))


def _known_tokens(profiles: DataFrame, pivots: DataFrame) -> DataFrame:
    """Prefix elements that may be among those of ``pivots``, with group and place: token, gid, place; the join drops the others."""
    shared = profiles.sparkSession.sparkContext.broadcast(
        bloom.build(pivots.select("token"), lambda batch: words.mix(batch.column(0).to_numpy().view(np.uint64))))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maybe = bloom.compact_reader(shared.value)
        for batch in batches:
            prefix = batch.column(1)
            offsets = prefix.offsets.to_numpy()
            tokens = prefix.values.to_numpy()[offsets[0]:offsets[-1]]
            gids = np.repeat(batch.column(0).to_numpy(), np.diff(offsets))
            places = (np.arange(offsets[0], offsets[-1]) - np.repeat(offsets[:-1], np.diff(offsets))).astype(np.int32)
            some = maybe(words.mix(tokens.view(np.uint64)))
            yield pa.RecordBatch.from_arrays([pa.array(tokens[some]), pa.array(gids[some]), pa.array(places[some])],
                                             names=["token", "gid", "place"])

    return profiles.select("gid", "prefix").mapInArrow(pick, "token long, gid long, place int")


def _filter_keys(batch: pa.RecordBatch, doc: int, text_hash: int) -> np.ndarray:
    one, two = (batch.column(k).to_numpy().view(np.uint64) for k in (doc, text_hash))
    return words.mix(words.mix(one) ^ two)


def _wanted_sets(rows: DataFrame, wanted: DataFrame, levels: np.ndarray, shingle: int, path: str) -> DataFrame:
    """Sets of the wanted documents (doc, text_hash): doc, text_hash, elements.

    The documents are told by a Bloom filter of fixed size while the texts are read, so neither texts nor sets are
    shuffled; what passes by chance is not asked for later.
    """
    packed = bloom.build(wanted.select("doc", "text_hash"), lambda batch: _filter_keys(batch, 0, 1))
    shared = rows.sparkSession.sparkContext.broadcast((packed, levels))

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maybe = bloom.compact_reader(shared.value[0])
        for batch in batches:
            keys = _filter_keys(batch, 0, 2)
            once = np.unique(keys, return_index=True)[1]  # repeated rows of a batch have one set
            some = batch.take(pa.array(np.sort(once[maybe(keys[once])])))
            for lo in range(0, some.num_rows, SET_ROWS):
                part = some.slice(lo, SET_ROWS)
                sets = [s.view(np.int64) for _, s in _sets(part, shared.value[1], shingle)]
                offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), words.ragged(offsets, np.concatenate(sets), pa.int64())],
                                                 names=["doc", "text_hash", "elements"])

    rows.mapInArrow(collect, "doc long, text_hash long, elements array<long>").write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def _verified(pairs: DataFrame, wanted: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose sets are similar enough; ``wanted`` has the document of each class."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            lo, ro = left.offsets.to_numpy(), right.offsets.to_numpy()
            lv, rv = left.values.to_numpy(), right.values.to_numpy()
            good = []
            for i in range(batch.num_rows):
                x, y = lv[lo[i]:lo[i + 1]], rv[ro[i]:ro[i + 1]]
                both = np.sort(np.concatenate([x, y]))
                common = int((both[1:] == both[:-1]).sum())
                good.append(100 * common >= percent * (len(x) + len(y) - common))
            mask = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    named = lambda k: wanted.select(F.col("cid").alias(k), F.col("doc").alias(f"doc_{k}"),
                                    F.col("text_hash").alias(f"hash_{k}"))
    stored = lambda k, c: sets.select(F.col("doc").alias(f"doc_{k}"), F.col("text_hash").alias(f"hash_{k}"),
                                      F.col("elements").alias(c))
    both = (pairs.join(named("a"), "a").join(named("b"), "b").join(stored("a", "x"), ["doc_a", "hash_a"])
            .join(stored("b", "y"), ["doc_b", "hash_b"]).select("a", "b", "x", "y"))
    return both.mapInArrow(check, "a long, b long")


def link(docs: DataFrame, *, shingle: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc (null ids are the smallest long), text_hash, n_shingles, first_doc, first_hash.

    A document's set are the different shingles of ``shingle`` words, A-Z lower-cased; shorter texts are one shingle.
    Documents link when their sets' Jaccard similarity is ``percent`` or more, and belong together when links connect
    them; ``first_doc`` and ``first_hash`` are the smallest id, and the hash of its text, that a document belongs with, itself
    included. Empty and null texts link with nothing. Repeated rows are copies of each other; other columns are left
    out; an empty table gives no rows.
    """
    spark = docs.sparkSession
    session.ship(spark)
    path = session.scratch(spark, "jaccard")
    at = lambda name: os.path.join(path, name)

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(at(name))
        return spark.read.parquet(at(name))

    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(_NULL_ID)).alias("doc"),
                       F.col(text).cast("string").alias("text"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"))
    levels = _levels(_bucket_counts(rows.select("doc", "text"), shingle))
    profiles = kept(_profiles(rows, levels, shingle, percent), "profiles")
    classes = kept(profiles.where("n > 0").groupBy(*_SET, "gid")
                   .agg(F.min(F.struct("doc", "text_hash")).alias("first"), F.first("sketch").alias("sketch"))
                   .withColumn("cid", F.monotonically_increasing_id()), "classes")
    members = classes.select("gid", "cid", "n")
    postings = profiles.select(F.explode("prefix").alias("token"), "gid")
    pivots = kept(postings.groupBy("token").agg(F.min("gid").alias("pivot"), F.max("gid").alias("last"))
                  .where("pivot < last").select("token", "pivot"), "pivots")
    shared = kept(_known_tokens(profiles, pivots).join(pivots, "token").distinct(), "shared")
    fits = lambda x, y: (100 * F.least(x, y) >= percent * F.greatest(x, y))
    leaders = members.groupBy("gid").agg(F.min("cid").alias("cid"), F.min("n").alias("n"))
    often = Window.partitionBy("gid").orderBy(F.desc("count"), "pivot")
    groups = (shared.where("gid <> pivot").groupBy("gid", "pivot").count().withColumn("k", F.row_number().over(often))
              .where(F.col("k") <= PIVOTS).select("gid", "pivot"))
    across = (groups.join(leaders, "gid").withColumnsRenamed({"cid": "b", "n": "n_b"})
              .join(leaders.withColumnsRenamed({"gid": "pivot", "cid": "a", "n": "n_a"}), "pivot")
              .where(fits(F.col("n_a"), F.col("n_b"))).select("a", "b"))
    within = (members.join(leaders.select("gid", F.col("cid").alias("a")), "gid").where("cid <> a")
              .select("a", F.col("cid").alias("b")))
    pairs = kept(across.unionByName(within).distinct(), "pairs-1")

    def check(pairs: DataFrame, name: str) -> DataFrame:
        of = lambda k: classes.select(*[F.col(c).alias(f"{c}_{k}") for c in ("cid", "n", "sketch")])
        most = F.least(F.col("n_a") - _missing("sketch_a", "sketch_b"), F.col("n_b") - _missing("sketch_b", "sketch_a"))
        pairs = kept(pairs.join(of("a"), F.col("a") == F.col("cid_a")).join(of("b"), (F.col("b") == F.col("cid_b")) & (
            (100 + percent) * most >= percent * (F.col("n_a") + F.col("n_b")))).select("a", "b"), f"close-{name}")
        nodes = pairs.select(F.col("a").alias("cid")).unionByName(pairs.select(F.col("b").alias("cid"))).distinct()
        wanted = kept(nodes.join(classes.select("cid", "first.*"), "cid"), f"wanted-{name}")
        sets = _wanted_sets(rows, wanted, levels, shingle, at(f"sets-{name}"))
        return kept(_verified(pairs, wanted, sets, percent), f"links-{name}")

    links = check(pairs, "1")
    labels = components(links)
    # groups are compared as a whole, by the least and greatest component their classes lie in so far: a row per group and element
    placed = kept(members.join(labels.withColumnRenamed("node", "cid"), "cid", "left")
                  .select("cid", "gid", "n", F.coalesce("label", "cid").alias("label")), "placed")
    bits = lambda fn: F.array(*[fn(F.get("sketch", F.lit(i))) for i in range(SKETCH)])
    spans = kept(placed.join(classes.select("cid", "sketch"), "cid").groupBy("gid").agg(
        F.min("n").alias("n"), F.min("label").alias("low"), F.max("label").alias("high"),
        bits(F.bit_and).alias("in_all"), bits(F.bit_or).alias("in_any")), "spans")
    cells = shared.select("token", "gid", "place").join(spans, "gid")
    mixed = cells.groupBy("token").agg(F.min("low").alias("least"), F.max("high").alias("most")).where("least < most").select("token")
    open_ = kept(cells.join(mixed, "token"), "open")
    left, right = (open_.select("token", *[F.col(c).alias(f"{c}{k}") for c in ("gid", "n", "low", "high", "place", "in_all", "in_any")])
                   for k in (1, 2))
    # all elements that two sets share stand at or behind the first of them, and what a sketch alone has is not shared
    enough = F.expr(f"({percent} * (n1 + n2) + {99 + percent}) div {100 + percent}")
    apart = F.least("low1", "low2") < F.greatest("high1", "high2")
    near = left.join(right, (left["token"] == right["token"]) & (F.col("gid1") < F.col("gid2")) & apart & fits(F.col("n1"), F.col("n2"))
                     & (F.least(F.col("n1") - F.col("place1"), F.col("n2") - F.col("place2")) >= enough)
                     & (F.col("n1") - _missing("in_all1", "in_any2") >= enough)).select("gid1", "gid2").distinct()
    near = near.unionByName(spans.where("low < high").select(F.col("gid").alias("gid1"), F.col("gid").alias("gid2")))
    of = lambda k: placed.select(*[F.col(c).alias(f"{c}{k}") for c in ("cid", "gid", "label")])
    more = (near.join(of(1), "gid1").join(of(2), "gid2")
            .where((F.col("label1") != F.col("label2")) & ((F.col("gid1") != F.col("gid2")) | (F.col("cid1") < F.col("cid2"))))
            .select(F.least("cid1", "cid2").alias("a"), F.greatest("cid1", "cid2").alias("b")))
    more = kept(more.join(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"),
                "pairs-2")
    if not more.isEmpty():
        found = check(more, "2")
        if not found.isEmpty():
            labels = components(links.unionByName(found))
    named = classes.select(*_SET, "cid", "first").join(labels.withColumnRenamed("node", "cid"), "cid", "left").select(
        *_SET, "first", F.coalesce("label", "cid").alias("label"))
    smallest = named.groupBy("label").agg(F.min("first").alias("lowest"))
    named = kept(named.join(smallest, "label").select(*_SET, "lowest"), "named")
    return profiles.select("doc", "text_hash", *_SET).join(named, _SET, "left").select(
        "doc", "text_hash", F.col("n").cast("long").alias("n_shingles"), F.coalesce("lowest.doc", "doc").alias("first_doc"),
        F.coalesce("lowest.text_hash", "text_hash").alias("first_hash"))


def deduplicate(docs: DataFrame, *, shingle: int = 5, percent: int = 80, doc_id: str = "doc_id",
                text: str = "text") -> DataFrame:
    """All columns of ``docs``, of each group of linked documents only the one of the smallest id; see :func:`link`.

    Repeated rows are copies: one of them stays. Documents without words all stay, but for repeated rows.
    """
    linked = link(docs, shingle=shingle, percent=percent, doc_id=doc_id, text=text)
    first = (linked.where("doc = first_doc and text_hash = first_hash").select(F.col("doc").alias("__doc"), F.col("text_hash")
                                                                               .alias("__hash")).distinct())
    keyed = (docs.withColumn("__d", F.coalesce(F.col(doc_id).cast("long"), F.lit(_NULL_ID)))
             .withColumn("__h", F.xxhash64(F.coalesce(F.col(text), F.lit("")))))
    kept = keyed.join(first, (F.col("__d") == F.col("__doc")) & (F.col("__h") == F.col("__hash")), "left_semi")
    return kept.dropDuplicates(["__d", "__h"]).drop("__d", "__h")
