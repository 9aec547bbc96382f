"""Sum-of-squares packing of documents into sequences of a fixed length.

A piece goes to the open sequence (or a new one) whose choice leaves the smallest sum, over all gap sizes, of the squared
number of open sequences with that gap. Each task packs the documents it reads and hands out a sequence once it is
full; the pieces of sequences still open at its end are packed once more, in large groups, so that few sequences
stay unfilled however many tasks there were.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens import session
from marketlens.llm import tokens

OPEN_SEQUENCES = 4096
GROUP_PIECES = 200_000
_PIECES = ("doc_id long, piece int, start long, length long, ids array<int>, ids_crc32 long, part int, row long, sequence_id long, "
           "offset long, open boolean")


class SumOfSquares:
    """Open sequences by gap; ``place`` chooses one for a length and returns its number and the place in it."""

    def __init__(self, size: int):
        self.size = size
        self.count = np.zeros(size + 1, np.int64)
        self.open: dict[int, list[int]] = {}
        self.made = 0

    def place(self, length: int) -> tuple[int, int]:
        """Number of the sequence and offset in it; the smaller gap wins a tie."""
        count, size = self.count, self.size
        if length == size:
            self.made += 1
            return self.made - 1, 0
        gaps = np.flatnonzero(count[length:]) + length
        after = np.concatenate([gaps, [size]]) - length
        change = np.where(after > 0, 2 * count[after] + 1, 0)
        change[:-1] -= 2 * count[gaps] - 1
        best = int(np.argmin(change))
        if best == len(gaps):
            number, gap = self.made, size
            self.made += 1
        else:
            gap = int(gaps[best])
            number = self.open[gap].pop()
            count[gap] -= 1
        if gap > length:
            count[gap - length] += 1
            self.open.setdefault(gap - length, []).append(number)
        return number, size - gap

    def tightest(self, n: int) -> list[int]:
        """Take ``n`` open sequences with the smallest gaps out of use and return their numbers."""
        out: list[int] = []
        for gap in range(1, self.size):
            while self.open.get(gap) and len(out) < n:
                out.append(self.open[gap].pop())
                self.count[gap] -= 1
        return out


def pieces_of(n: int, size: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of ``n`` ids: pieces of ``size``, the first one shorter where ``n`` asks for it."""
    first = n % size or size
    cuts = [0, *range(first, n + 1, size)]
    return [(a, b - a) for a, b in zip(cuts[:-1], cuts[1:])]


def pack(docs: DataFrame, tokenizer: str, end_id: int, *, spaced: bool, size: int = 1024, doc_id: str = "doc_id",
         text: str = "text", checksum: bool = False) -> DataFrame:
    """Pack all texts: one row per piece with doc_id, piece, start, length, ids, sequence_id, offset.

    ``checksum`` adds ids_crc32, the unsigned CRC-32 of a piece's ids as little-endian 32-bit integers, taken where the piece is made.

    Null texts count as empty (the end id alone); repeated rows are packed as often as they occur; null ids stay null;
    other columns are left out; an empty table gives no rows. Only documents of more than ``size`` ids are cut.
    """
    spark = docs.sparkSession
    session.ship(spark)
    path = session.scratch(spark, "packing")

    def first_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids, end = tokens.encoder(tokenizer, spaced), np.array([end_id], "<u4").tobytes()
        part, row, bins = TaskContext.get().partitionId(), 0, SumOfSquares(size)
        held: dict[int, list[tuple]] = {}
        ready: list[tuple] = []

        def flush() -> pa.RecordBatch:
            ids = [np.frombuffer(r[4], "<i4") for r in ready]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            flat = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))
            of = lambda k, kind: pa.array([r[k] for r in ready], kind)
            batch = pa.RecordBatch.from_arrays(
                [of(0, pa.int64()), of(1, pa.int32()), of(2, pa.int64()), of(3, pa.int64()), flat,
                 pa.array([zlib.crc32(r[4]) for r in ready], pa.int64()), pa.array(np.full(len(ready), part, np.int32)), of(5, pa.int64()), of(6, pa.int64()), of(7, pa.int64()),
                 of(8, pa.bool_())],
                names=["doc_id", "piece", "start", "length", "ids", "ids_crc32", "part", "row", "sequence_id", "offset", "open"])
            ready.clear()
            return batch

        def close(number: int, still_open: bool) -> None:
            ready.extend((*r, still_open) for r in held.pop(number))

        for batch in batches:
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = to_ids(value or "") + end
                for k, (start, length) in enumerate(pieces_of(len(found) // 4, size)):
                    number, offset = bins.place(length)
                    held.setdefault(number, []).append((key, k, start, length, found[4 * start:4 * (start + length)], row,
                                                        part << 32 | number, offset))
                    row += 1
                    if offset + length == size:
                        close(number, False)
                    if len(held) > OPEN_SEQUENCES:
                        for n in bins.tightest(OPEN_SEQUENCES // 2):
                            close(n, True)
                if len(ready) > 2000:
                    yield flush()
        for n in list(held):
            close(n, True)
        if ready:
            yield flush()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows.mapInArrow(first_round, _PIECES).write.partitionBy("open").parquet(path)
    table = spark.read.schema(_PIECES).parquet(path)
    done = ["doc_id", "piece", "start", "length", "ids", *(["ids_crc32"] if checksum else []), "sequence_id", "offset"]
    left = table.where("open").select("part", "row", "length")
    groups = max(1, -(-left.count() // GROUP_PIECES))

    def second_round(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "part", "row"], ascending=[False, True, True], ignore_index=True)
        bins = SumOfSquares(size)
        found = [bins.place(int(n)) for n in group["length"]]
        base = (1 << 62) + (int(key[0]) << 32)
        return group[["part", "row"]].assign(sequence_id=[base + n for n, _ in found], offset=[o for _, o in found])

    again = (left.withColumn("g", F.pmod(F.xxhash64("part", "row"), F.lit(groups))).groupBy("g")
             .applyInPandas(second_round, "part int, row long, sequence_id long, offset long"))
    again_path = os.path.join(session.scratch(spark, "packing-again"), "places")
    again.write.parquet(again_path)
    repacked = (table.where("open").drop("sequence_id", "offset")
                .join(spark.read.parquet(again_path), ["part", "row"]).select(done))
    return table.where("not open").select(done).unionByName(repacked)
