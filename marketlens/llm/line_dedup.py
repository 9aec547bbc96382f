"""Line de-duplication over ranges of line hashes, with per-document bitmaps of the lines to keep.

Line keys are hashed, dealt over ranges of (hash, document, position) and sorted; each task streams its range once and
marks all lines of a key but those of the key's first document. A frequent key may span many ranges: each task
also hands out its first key's lines undecided and one summary row, and what the ranges before it hold settles these.
The result has no texts: a compressed bitmap per document that loses lines.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens import session
from marketlens.llm.words import BLANKS, ascii_lower

MIN_CHARS = 10
_NULL_ID = -(1 << 63)  # stands for a null id, before all others
_MARKED = ("summary boolean, part int, doc long, text_hash long, pos int, drop boolean, edge boolean, "
           "first1 long, first2 long, last1 long, last2 long")


def _ids(doc_id: str, text: str) -> list[Column]:
    return [F.coalesce(F.col(doc_id).cast("long"), F.lit(_NULL_ID)).alias("doc"),
            F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash")]


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines to drop and lines of the range's first key, then the range's summary."""
    part, first, last, last_doc, at_edge = TaskContext.get().partitionId(), None, None, 0, True
    for batch in batches:
        if not batch.num_rows:
            continue
        h1, h2, doc, text_hash, pos = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(5))
        if first is None:
            first = last = (int(h1[0]), int(h2[0]))
            last_doc = int(doc[0])
        new = np.empty(len(h1), bool)
        new[0] = (int(h1[0]), int(h2[0])) != last
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        group = np.maximum.accumulate(np.where(new, np.arange(len(h1)), -1))
        head = np.where(group >= 0, doc[group], last_doc)
        edge = (group < 0) & at_edge
        drop = doc > head
        out = drop | edge
        n, none = int(out.sum()), pa.nulls(int(out.sum()), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.zeros(n, bool)), pa.array(np.full(n, part, np.int32)), pa.array(doc[out]), pa.array(text_hash[out]),
             pa.array(pos[out], pa.int32()), pa.array(drop[out]), pa.array(edge[out]), none, none, none, none],
            names=["summary", "part", "doc", "text_hash", "pos", "drop", "edge", "first1", "first2", "last1", "last2"])
        at_edge = at_edge and not new.any()
        last, last_doc = (int(h1[-1]), int(h2[-1])), int(head[-1])
    if first is not None:
        row = [True, part, last_doc, None, None, None, None, *first, *last]
        kinds = [pa.bool_(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), *[pa.int64()] * 4]
        yield pa.RecordBatch.from_arrays(
            [pa.array([v], k) for v, k in zip(row, kinds)],
            names=["summary", "part", "doc", "text_hash", "pos", "drop", "edge", "first1", "first2", "last1", "last2"])


def _carried(summaries: list) -> list[tuple[int, int]]:
    """For each range that goes on with the key of the range before it: its number and the key's first document."""
    out, key, doc = [], None, 0
    for s in sorted(summaries, key=lambda r: r["part"]):
        first, last = (s["first1"], s["first2"]), (s["last1"], s["last2"])
        goes_on = first == key
        if goes_on:
            out.append((s["part"], doc))
        if not goes_on or last != first:
            key, doc = last, s["doc"]
    return out


def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        maps, counts = [], []
        for places in batch.column(2).to_pylist():
            keep = np.ones(-(-(max(places) + 1) // 8) * 8, bool)
            keep[places] = False
            counts.append(len(places))
            maps.append(zlib.compress(np.packbits(keep).tobytes()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64()),
                                          pa.array(maps, pa.binary())], names=["doc", "text_hash", "n_dropped", "keep"])


def keep_bitmaps(docs: DataFrame, *, min_chars: int = MIN_CHARS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document that loses lines: doc, text_hash, n_dropped, keep.

    A line's key is the line without blanks at both ends and with A-Z lower-cased; keys of fewer than ``min_chars``
    characters count for nothing. Of a key that several documents hold, only the lines of the smallest id stay. ``keep`` is
    a compressed bitmap, a bit per line up to the last dropped one and set bits to fill the byte; later lines stay. Null ids are one document
    before all others (``doc`` is the smallest long); rows of the same id are one document; null texts are one empty
    line; an empty table gives no rows.
    """
    spark = docs.sparkSession
    session.ship(spark)
    key = ascii_lower(F.btrim("line", F.lit(BLANKS)))
    lines = (docs.select(*_ids(doc_id, text), F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1))
                         .alias("pos", "line"))
             .select("doc", "text_hash", "pos", key.alias("key")).where(F.length("key") >= min_chars)
             .select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc", "text_hash", "pos"))
    order = ["h1", "h2", "doc", "text_hash", "pos"]
    path = session.scratch(spark, "line-marks")
    (lines.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_mark, _MARKED)
     .write.partitionBy("summary").parquet(path))
    marks = spark.read.schema(_MARKED).parquet(path)
    # one summary per range: as many rows as the shuffle has partitions
    carried = _carried(marks.where("summary").select("part", "doc", "first1", "first2", "last1", "last2").collect())
    marks = marks.where("not summary")
    if carried:
        before = spark.createDataFrame(carried, "part int, before long").coalesce(1)
        marks = (marks.join(F.broadcast(before), "part", "left")
                 .where("drop or (edge and doc > before)"))
    else:
        marks = marks.where("drop")
    places = marks.groupBy("doc", "text_hash").agg(F.collect_set("pos").alias("places"))
    return places.mapInArrow(_compress, "doc long, text_hash long, n_dropped long, keep binary")


def _kept_lines(text: pd.Series, keep: pd.Series) -> pd.Series:
    def one(t: str | None, k: bytes | None) -> str | None:
        if t is None or k is None:
            return None
        bits = np.unpackbits(np.frombuffer(zlib.decompress(k), np.uint8))
        lines = t.split("\n")
        return "\n".join([x for i, x in enumerate(lines) if i >= len(bits) or bits[i]])
    return pd.Series([one(t, k) for t, k in zip(text, keep)], dtype=object)


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with the text reduced to its kept lines, and ``n_dropped`` (0 for most).

    A null text stays null. A column of the name ``n_dropped`` is replaced.
    """
    session.ship(docs.sparkSession)
    columns = [c for c in docs.columns if c not in ("n_dropped", text)]
    ids = _ids(doc_id, text)
    right = bitmaps.select(F.col("doc").alias("__doc"), F.col("text_hash").alias("__hash"), F.col("keep").alias("__keep"),
                           F.col("n_dropped").alias("__n"))
    left = docs.select("*", ids[0].alias("__d"), ids[1].alias("__h"))
    joined = left.join(right, (left["__d"] == right["__doc"]) & (left["__h"] == right["__hash"]), "left")
    cut = F.pandas_udf(_kept_lines, "string")
    kept = F.coalesce(cut(F.when(F.col("__keep").isNotNull(), F.col(text)), F.col("__keep")), F.col(text))
    out = joined.select(*columns, kept.alias(text), F.coalesce("__n", F.lit(0)).alias("n_dropped"))
    return out.select(*[c for c in docs.columns if c != "n_dropped"], "n_dropped")
