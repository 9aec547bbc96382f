"""Phrases whose words occur together more often than their parts do, per language.

Direct-address tiling: units (words, then frequent pairs, then frequent triples) are ranked by frequency. Neighbouring units
whose ranks fall into a dense tile of the rank plane are counted by position in an array; all others are counted
as sorted coordinates. Frequent pairs become the units of the next level, ranked anew: two overlapping pairs make a triple, two
overlapping triples a phrase of four words. Only what is frequent can be part of something frequent, so everything
else is left out by Bloom filters before it is shuffled; counts of what is left are exact.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens import session
from marketlens.llm import bloom
from marketlens.llm.words import mix

BREAKS = ".,;:!?\n\x0b\x0c\r"  # between pieces; blanks and tabs stand between words
MIN_COUNT = 30
MAX_WORDS = 4
TOP = 2000
COVER_PERCENT = 80  # a phrase goes if a longer one accounts for that share of it
UNKNOWN = "und"
RANK_SHARES = 64

TILE = 256
DENSE = 8  # tile (i, j) is dense if (i + 1) * (j + 1) is at most this: frequent with frequent
DENSE_LANGS = 16  # the largest languages have dense tiles (20 each, of TILE * TILE cells); others count by coordinates
BLOCK_BYTES = 2 << 20
SEGMENT_BYTES = 1 << 20
BUFFERED_PAIRS = 1 << 20

_TILES = {(i, j): k for k, (i, j) in enumerate((i, j) for i in range(DENSE) for j in range(DENSE) if (i + 1) * (j + 1) <= DENSE)}
_TILE_OF = np.array([[_TILES.get((i, j), -1) for j in range(DENSE)] for i in range(DENSE)])
_RANKS = TILE * DENSE
_CELLS = len(_TILES) * TILE * TILE

_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_IS_BREAK = np.isin(np.arange(256), list(BREAKS.encode()))
_IS_WORD = ~(_IS_BREAK | np.isin(np.arange(256), [32, 9]))
_BASE = 0x5851F42D4C957F2D
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, modulo 2^64."""
    size = 1 << max(20, (n - 1).bit_length())
    if size not in _powers:
        _powers.clear()
        of = lambda b: np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, np.uint64(b))]), dtype=np.uint64)
        _powers[size] = of(_BASE), of(pow(_BASE, -1, 1 << 64))
    return _powers[size]


def _segments(buf: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about ``SEGMENT_BYTES`` that end between words."""
    i = 0
    while i < len(buf):
        j = min(len(buf), i + SEGMENT_BYTES)
        while j < len(buf):
            between = np.flatnonzero(~_IS_WORD[buf[i:j]])
            if len(between):
                j = i + int(between[-1]) + 1
                break
            j = min(len(buf), j + SEGMENT_BYTES)
        yield i, j
        i = j


def tokens(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, 64-bit hash (A-Z lower-cased) and number of the piece of each word in UTF-8 ``data``."""
    buf, out, pieces = np.frombuffer(data, np.uint8), [[], [], [], []], 0
    for i, j in _segments(buf):
        part = _FOLD[buf[i:j]]
        edge = np.flatnonzero(np.diff(_IS_WORD[part], prepend=False, append=False))
        starts, ends = edge[0::2], edge[1::2]
        power, inverse = _power_tables(len(part))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[part] * power[:len(part)], dtype=np.uint64)])
        breaks = np.cumsum(_IS_BREAK[part])
        for kept, new in zip(out, (starts + i, ends + i, mix((sums[ends] - sums[starts]) * inverse[starts]
                                                             + (ends - starts).astype(np.uint64)), breaks[starts] + pieces)):
            kept.append(new)
        pieces += int(breaks[-1])
    kinds = (np.int64, np.int64, np.uint64, np.int64)
    return tuple(np.concatenate([np.empty(0, t), *kept]).astype(t) for kept, t in zip(out, kinds))


def _language_key(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, list[str], np.ndarray]]:
    """Texts of about ``BLOCK_BYTES`` put together, with the language and the begin of each (column 0: lang, 1: text)."""
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary())
        lo = 0
        while lo < len(langs):
            parts, size, hi = [], 0, lo
            while hi < len(langs) and size < BLOCK_BYTES:
                parts.append(texts[hi].as_py())
                size += len(parts[-1]) + 1
                hi += 1
            begins = np.cumsum([0, *(len(p) + 1 for p in parts[:-1])])
            yield b"\n".join(parts), langs[lo:hi], begins
            lo = hi


def _words(data: bytes, langs: list[str], begins: np.ndarray) -> tuple[np.ndarray, ...]:
    """Start, end, key (of word and language), piece and row of each word of a block."""
    starts, ends, hashes, pieces = tokens(data)
    rows = np.searchsorted(begins, starts, "right") - 1
    tags = {lang: _language_key(lang) for lang in set(langs)}
    tag = np.array([tags[lang] for lang in langs], np.uint64)
    return starts, ends, mix(hashes ^ tag[rows]), pieces, rows


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, lang, word, n: the words of each block; a row without word has the number of all words of the language."""
    for data, langs, begins in _blocks(batches):
        starts, ends, keys, _, rows = _words(data, langs, begins)
        if not len(keys):
            continue
        found, at, counts = np.unique(keys, return_index=True, return_counts=True)
        sizes = (ends - starts)[at]
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        place = np.arange(offsets[-1]) + np.repeat(starts[at] - offsets[:-1], sizes)
        folded = _FOLD[np.frombuffer(data, np.uint8)[place]]
        text = pa.LargeStringArray.from_buffers(len(found), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(folded))
        lang = pa.array(langs, pa.string()).take(pa.array(rows[at]))
        yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), lang, text.cast(pa.string()), pa.array(counts)],
                                         names=["key", "lang", "word", "n"])
        totals = np.bincount(rows, minlength=len(langs))
        yield pa.RecordBatch.from_pydict(
            {"key": [0] * len(langs), "lang": langs, "word": [None] * len(langs), "n": totals.tolist()},
            pa.schema([("key", pa.int64()), ("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())]))


def pair_key(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Key of two neighbouring units."""
    return mix(mix(u ^ np.uint64(0xD6E8FEB86659FD93)) + v)


class _Tally:
    """Counts of neighbouring units: an array per dense tile, sorted coordinates for the rest."""

    def __init__(self, heads: list[np.ndarray]):
        self.keys = np.concatenate([np.empty(0, np.uint64), *heads])
        order = np.argsort(self.keys)
        self.sorted = self.keys[order]
        rank = np.concatenate([np.empty(0, np.int64), *(np.arange(len(h)) for h in heads)])
        slot = np.concatenate([np.empty(0, np.int64), *(np.full(len(h), s) for s, h in enumerate(heads))])
        self.rank, self.slot, self.heads = rank[order], slot[order], heads
        self.dense: dict[int, np.ndarray] = {}
        self.rest: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def _ranked(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.sorted):
            return np.full(len(units), -1), np.full(len(units), -1)
        at = np.minimum(np.searchsorted(self.sorted, units), len(self.sorted) - 1)
        hit = self.sorted[at] == units
        return np.where(hit, self.rank[at], -1), np.where(hit, self.slot[at], -1)

    def add(self, units: np.ndarray, at: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Count the units at ``at`` with their right neighbours."""
        rank, slot = self._ranked(units)
        a, b = rank[at], rank[at + 1]
        tile = np.where((a >= 0) & (b >= 0) & (slot[at] == slot[at + 1]), _TILE_OF[a // TILE, b // TILE], -1)
        near = tile >= 0
        cell = (tile[near] * TILE + a[near] % TILE) * TILE + b[near] % TILE
        owner = slot[at][near]
        for s in np.unique(owner):
            found = np.bincount(cell[owner == s], minlength=_CELLS)
            self.dense[s] = self.dense[s] + found if s in self.dense else found
        far = at[~near]
        self.rest.append((units[far], units[far + 1]))
        self.size += len(far)
        if self.size >= BUFFERED_PAIRS:
            yield self._sparse()

    def _batch(self, u: np.ndarray, v: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        of = lambda x: pa.array(x.view(np.int64))
        return pa.RecordBatch.from_arrays([of(u), of(v), pa.array(n)], names=["u", "v", "n"])

    def _sparse(self) -> pa.RecordBatch:
        u, v = (np.concatenate([np.empty(0, np.uint64), *(r[k] for r in self.rest)]) for k in (0, 1))
        self.rest, self.size = [], 0
        _, at, counts = np.unique(pair_key(u, v), return_index=True, return_counts=True)
        return self._batch(u[at], v[at], counts)

    def finish(self) -> Iterator[pa.RecordBatch]:
        """What has not been given out yet."""
        yield self._sparse()
        corner = np.array(list(_TILES))
        for s, counts in self.dense.items():
            cell = np.flatnonzero(counts)
            tile, inner = np.divmod(cell, TILE * TILE)
            a, b = corner[tile, 0] * TILE + inner // TILE, corner[tile, 1] * TILE + inner % TILE
            yield self._batch(self.heads[s][a], self.heads[s][b], counts[cell])


def _neighbours(docs: DataFrame, heads: list[np.ndarray], filters: list[bytes], least: int) -> DataFrame:
    """key, u, v, n: neighbouring units that occur often; units are words joined as often as there are further filters."""
    context = docs.sparkSession.sparkContext
    ranked, known = context.broadcast(heads), context.broadcast(filters)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally, maybe = _Tally(ranked.value), [bloom.compact_reader(f) for f in known.value]
        for block in _blocks(batches):
            _, _, units, pieces, _ = _words(*block)
            good = maybe[0](units)
            for frequent in maybe[1:]:
                at = np.flatnonzero(good[:-1] & good[1:] & (pieces[:-1] == pieces[1:]))
                keys = pair_key(units[at], units[at + 1])
                keep = frequent(keys)
                units, good = units.copy(), np.zeros(len(units), bool)
                units[at[keep]], good[at[keep]] = keys[keep], True
            # Unit i begins at word i; two units in turn overlap, so they are in one piece if both begins are.
            yield from tally.add(units, np.flatnonzero(good[:-1] & good[1:] & (pieces[:-1] == pieces[1:])))
        yield from tally.finish()

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = pair_key(*(batch.column(k).to_numpy().view(np.uint64) for k in (0, 1)))
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), *batch.columns], names=["key", "u", "v", "n"])

    found = docs.mapInArrow(counted, "u long, v long, n long")
    often = found.groupBy("u", "v").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return often.mapInArrow(keyed, "key long, u long, v long, n long")


def cut_score(a: Column, left: Column, right: Column) -> Column:
    """floor(2000000 * a / (left + right)), exact also where the product passes 64 bits."""
    wide = lambda c: c.cast("decimal(19,0)")
    top, bottom = F.lit(2_000_000).cast("decimal(7,0)") * wide(a), wide(left) + wide(right)
    return ((top - top % bottom) / bottom).cast("long")


def _heads(units: DataFrame, langs: list[str]) -> list[np.ndarray]:
    """Keys of the units that have a rank in the tiles, by rank, for each of the languages (at most DENSE_LANGS * _RANKS keys)."""
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "key")
    rows = (units.where(F.col("lang").isin(langs)).select("lang", "key", "n").withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= _RANKS).select("lang", "key", "rank").toArrow().sort_by("rank"))
    keys, owner = rows["key"].to_numpy().view(np.uint64), np.array(rows["lang"].to_pylist(), object)
    return [keys[owner == lang] for lang in langs]


def phrases(docs: DataFrame, *, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z), cut into pieces at ``BREAKS`` and into words at blanks and tabs. A phrase has 2 to ``MAX_WORDS`` words and
    occurs ``a`` >= ``min_count`` times within pieces, overlaps included. Cutting it into two parts that occur ``l`` and ``r`` times
    gives floor(2000000 a / (l + r)); the lowest of its cuts is its score, the earliest of equal ones. Phrases of which a longer one
    has ``COVER_PERCENT`` go. Order: score, a, then phrase. ``n`` is the number of words of the language.

    Null texts are empty, a null language is ``und``; ids do not matter and repeated rows count each time; other columns are left
    out; without frequent phrases there are no rows. Words and phrases are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    session.ship(spark)
    path = session.scratch(spark, "collocations")

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(os.path.join(path, name))
        return spark.read.parquet(os.path.join(path, name))

    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    counts = rows.mapInArrow(_count_words, "key long, lang string, word string, n long")
    words = kept(counts.groupBy("key", "lang", "word").agg(F.sum("n").alias("n"))
                 .where((F.col("n") >= min_count) | F.col("word").isNull()), "words")
    sizes = words.where(F.col("word").isNull()).select("lang", F.col("n").alias("total"))
    langs = [r[0] for r in sizes.orderBy(F.desc("total"), "lang").limit(DENSE_LANGS).collect()]
    units = words.where(F.col("word").isNotNull()).select(
        "key", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "n",
        F.array("n").alias("heads"), F.array("n").alias("tails"))
    filters, levels = [], []
    for size in range(2, MAX_WORDS + 1):
        filters.append(bloom.build(units.select("key"), lambda batch: batch.column(0).to_numpy().view(np.uint64)))
        found = _neighbours(rows, _heads(units, langs), filters, min_count)
        first = units.select(F.col("key").alias("u"), "lang", F.col("phrase").alias("start"), "heads")
        second = units.select(F.col("key").alias("v"), "last", "tails")
        units = kept(found.join(first, "u").join(second, "v").select(
            "key", "u", "v", "lang", F.concat_ws(" ", "start", "last").alias("phrase"), "last", "n",
            F.concat("heads", F.array("n")).alias("heads"), F.concat("tails", F.array("n")).alias("tails")), f"phrases-{size}")
        levels.append(units)
    ranked = None
    for size, level in enumerate(levels, 2):
        cuts = [F.struct(cut_score(F.col("n"), F.col("heads")[k - 1], F.col("tails")[size - k - 1]).alias("score"), F.lit(k).alias("k"),
                         F.col("heads")[k - 1].alias("l"), F.col("tails")[size - k - 1].alias("r")) for k in range(1, size)]
        if size < MAX_WORDS:
            longer = levels[size - 1]
            cover = (longer.select(F.col("u").alias("key"), F.col("n").alias("f"))
                     .unionByName(longer.select(F.col("v").alias("key"), F.col("n").alias("f")))
                     .groupBy("key").agg(F.max("f").alias("f")))
            level = level.join(cover, "key", "left").where(
                F.col("f").isNull() | (F.col("f") * 100 < F.col("n") * COVER_PERCENT))
        level = level.select("lang", "phrase", F.col("n").alias("a"), F.array_min(F.array(*cuts)).alias("c"))
        ranked = level if ranked is None else ranked.unionByName(level)
    # First within shares of a language, so that the last step has few rows however many phrases there are.
    order = [F.desc("c.score"), F.desc("a"), F.col("phrase")]
    best = ranked.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(RANK_SHARES)))
    for by in (["lang", "share"], ["lang"]):
        place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        best = best.withColumn("rank", place).where(F.col("rank") <= top)
    return best.join(sizes, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("c.l").alias("l"), F.col("c.r").alias("r"),
        F.col("total").alias("n"), F.col("c.score").alias("score"))
