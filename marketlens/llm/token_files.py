"""Token ids in ORC files: integer run-length encoded stripes, row indexes, Bloom filters on the document id.

``write_tokens`` orders the texts by document id over ranges, encodes each range in its own task and writes one file per
range; a manifest beside the files says which ids and how many tokens each range has. ``read_tokens`` gives the
documents back with the number of tokens before each; conditions on the document id reach the file, stripe and row
group statistics and the Bloom filters, and each task reads its own stripes.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlens import session
from marketlens.llm import tokens, words

ROW_INDEX_STRIDE = 1000
STRIPE_BYTES = 32 << 20
ROWS_PER_BATCH = 512


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, *, spaced: bool, doc_id: str = "doc_id",
                 text: str = "text") -> None:
    """Encode all texts and write them under ``path`` in ascending ``doc_id`` order.

    ``tokenizer`` is the file of a tokenizer that every executor can read; ``spaced`` as in :func:`tokens.encoder`. Null
    texts count as empty: they get the end id alone. Null ids come first; rows with the same id stand in the order of
    their texts' hashes and texts. Other columns are left out. An empty table gives no rows.
    """
    session.ship(docs.sparkSession)
    ordered = (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
               .withColumn("text_hash", F.xxhash64("text")))
    ordered = (ordered.repartitionByRange("doc_id", "text_hash")
               .sortWithinPartitions("doc_id", "text_hash", "text").select("doc_id", "text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids = tokens.encoder(tokenizer, spaced)
        end = np.array([end_id], "<u4").tobytes()
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS_PER_BATCH):
                piece = batch.slice(lo, ROWS_PER_BATCH)
                found = [to_ids(t) + end for t in piece.column(1).to_pylist()]
                sizes = np.array([len(x) // 4 for x in found], np.int64)
                ends = np.cumsum(sizes)
                flat = np.frombuffer(b"".join(found), "<i4")
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(np.full(len(sizes), part, np.int32)), pa.array(before + ends - sizes),
                     pa.array(sizes), words.ragged(np.concatenate([[0], ends]), flat, pa.int32())],
                    names=["doc_id", "part", "before", "n_tokens", "tokens"])
                before += int(ends[-1])

    encoded = ordered.mapInArrow(encode, "doc_id long, part int, before long, n_tokens long, tokens array<int>")
    (encoded.write.mode("overwrite").option("compression", "snappy").option("orc.bloom.filter.columns", "doc_id")
     .option("orc.bloom.filter.fpp", "0.01").option("orc.row.index.stride", ROW_INDEX_STRIDE)
     .option("orc.stripe.size", STRIPE_BYTES).orc(os.path.join(path, "tokens")))
    spark = docs.sparkSession
    (spark.read.orc(os.path.join(path, "tokens")).groupBy("part")
     .agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"), F.count("*").alias("n_docs"),
          F.sum("n_tokens").alias("n_tokens"))
     .write.mode("overwrite").orc(os.path.join(path, "manifest")))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """All documents under ``path``: doc_id, start (tokens of all documents before it), n_tokens, tokens.

    The manifest has one row per written range, so its running sum is small; the ranges' numbers ascend with the ids.
    """
    manifest = spark.read.orc(os.path.join(path, "manifest"))
    shift = manifest.select("part", (F.sum("n_tokens").over(Window.orderBy("part")) - F.col("n_tokens")).alias("shift"))
    return (spark.read.orc(os.path.join(path, "tokens")).join(shift, "part")
            .select("doc_id", (F.col("before") + F.col("shift")).alias("start"), "n_tokens", "tokens"))


def with_checksum(df: DataFrame, ids: str = "tokens", name: str = "ids_crc32") -> DataFrame:
    """Replace the column of ids by the unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    session.ship(df.sparkSession)
    kept = [f for f in df.schema.fields if f.name != ids]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"`{name}` long"])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            offsets = column.offsets.to_numpy().astype(np.int64) * 4
            flat = memoryview(np.ascontiguousarray(column.values.to_numpy(zero_copy_only=False), "<i4")).cast("B")
            sums = [zlib.crc32(flat[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
            arrays = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(sums, pa.int64())], names=[*[f.name for f in kept], name])

    return df.mapInArrow(check, schema)
