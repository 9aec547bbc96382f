"""Words of texts: column expressions for native operators, hashed words for operators on Arrow batches.

A word is a run of characters other than space and ``\\t`` to ``\\r``. The Arrow side works on UTF-8 bytes; words are
64-bit hashes of the word with A-Z lower-cased, computed for a whole block of texts at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\f\r"
BLOCK_BYTES = 4 << 20
SEGMENT_BYTES = 1 << 20
_POWERS = 1 << 12

_seed = np.arange(1, 257, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (a bijection, so distinct values stay distinct)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(_seed * np.uint64(0x9E3779B97F4A7C15))
_BYTE_FOLDED = _BYTE.copy()
_BYTE_FOLDED[65:91] = _BYTE[97:123]
_POWER = np.cumprod(np.concatenate([[np.uint64(1)], np.full(_POWERS - 1, np.uint64(0x5851F42D4C957F2D))]), dtype=np.uint64)
_IS_BLANK = np.zeros(256, dtype=bool)
_IS_BLANK[[32, 9, 10, 11, 12, 13]] = True


def _segment(buf: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = ~_IS_BLANK[buf]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edge[0::2], edge[1::2]
    if not len(starts):
        return starts, np.empty(0, np.uint64)
    lengths = ends - starts
    at = np.flatnonzero(inside)
    rank = np.arange(len(at)) - np.repeat(np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
    terms = table[buf[at]] * _POWER[rank % _POWERS]
    sums = np.add.reduceat(terms, np.concatenate([[0], np.cumsum(lengths)[:-1]]))
    return starts, mix(sums + lengths.astype(np.uint64))


def hashed_words(data: bytes, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Start offsets and hashes of all words in ``data``, worked out in segments that end at a blank."""
    buf = np.frombuffer(data, np.uint8)
    table = _BYTE_FOLDED if fold else _BYTE
    starts, hashes, i = [np.empty(0, np.int64)], [np.empty(0, np.uint64)], 0
    while i < len(buf):
        j = min(len(buf), i + SEGMENT_BYTES)
        while j < len(buf):
            blanks = np.flatnonzero(_IS_BLANK[buf[i:j]])
            if len(blanks):
                j = i + int(blanks[-1]) + 1
                break
            j = min(len(buf), j + SEGMENT_BYTES)
        s, h = _segment(buf[i:j], table)
        starts.append(s + i)
        hashes.append(h)
        i = j
    return np.concatenate(starts), np.concatenate(hashes)


def blocks(batch: pa.RecordBatch, text: int = 1) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices of a batch of about ``BLOCK_BYTES``: first row, end row, word hashes, first word of each row (and the end).

    Null texts have no words.
    """
    column = batch.column(text).cast(pa.large_binary())
    sizes = np.diff(np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1])
    ends = np.cumsum(sizes)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + BLOCK_BYTES, "right")))
        parts = [b or b"" for b in column.slice(lo, hi - lo).to_pylist()]
        begins = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts])])
        starts, hashes = hashed_words(b"\n".join(parts))
        yield lo, hi, hashes, np.searchsorted(starts, begins)
        lo = hi


def shingles(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words within one row, and the row of each; a shorter row is one run as a whole."""
    counts = np.diff(first)
    rows = np.repeat(np.arange(len(counts)), counts)
    parts, owners = [], []
    if len(hashes) >= n:
        h = np.full(len(hashes) - n + 1, np.uint64(n))
        for k in range(n):
            h = mix(h ^ hashes[k:len(hashes) - n + 1 + k]) + np.uint64(k)
        same = rows[:len(h)] == rows[n - 1:]
        parts.append(h[same])
        owners.append(rows[:len(h)][same])
    for r in np.flatnonzero((counts > 0) & (counts < n)):
        h = np.full(1, int(counts[r]) * 0x9E3779B97F4A7C15 & (1 << 64) - 1, np.uint64)
        for k, w in enumerate(hashes[first[r]:first[r + 1]]):
            h = mix(h ^ w) + np.uint64(k)
        parts.append(h)
        owners.append(np.array([r]))
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    h, owner = np.concatenate(parts), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return h[order], owner[order]


def ragged(offsets: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from row offsets and flat values."""
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def words(text: Column | str) -> Column:
    """Array of the words of a text; empty for null."""
    column = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.coalesce(column, F.lit("")), r"[\x20\x09-\x0D]+", -1), "")


def ascii_lower(column: Column) -> Column:
    """A-Z lower-cased, all else as it is."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
