"""Words of texts without blanks: the best path through a dictionary."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, StringType

#: A dictionary is handed to all tasks; it is a word list of a language, not data, and must not have more words than this.
MAX_WORDS = 1_000_000
# Scripts that are written without blanks.
UNSPACED = "⺀-⻿぀-ヿㇰ-ㇿ㐀-䶿一-鿿豈-﫿฀-໿က-႟ក-៿"
_RUN = re.compile(r"[^\W_]+")
_UNSPACED = re.compile(f"[{UNSPACED}]")
_PART = re.compile(f"[{UNSPACED}]+|[^{UNSPACED}]+")
# Characters that are cut at a time, and how many of the longest pieces among them are cut one by one.
BLOCK, FEW = 1 << 18, 8
# Steps of a dictionary that are looked up in a plain table; those of a larger one are searched.
TABLE = 1 << 22
# Price of a character outside the dictionary, in words.
_OUTSIDE = 1 << 32


class Trie:
    """The words of a dictionary, each with a weight, by their beginnings."""

    def __init__(self, words: dict[str, float]):
        self.nodes: dict[str, float | None] = {}
        for word in words:
            for k in range(1, len(word)):
                self.nodes.setdefault(word[:k], None)
        self.nodes.update(words)

    def words_at(self, text: str, i: int) -> Iterator[tuple[int, float]]:
        """End and weight of each word that begins at a place."""
        for j in range(i + 1, len(text) + 1):
            part = text[i:j]
            if part not in self.nodes:
                return
            weight = self.nodes[part]
            if weight is not None:
                yield j, weight


def best_path(text: str, trie: Trie) -> list[str]:
    """Cut a text into words: as few characters outside the dictionary as can be, then as few words, then the greatest sum of weights.

    Of equal paths the one with the longer first word is taken. Characters outside the dictionary are words of their own.
    """
    best: list[tuple[int, int, float, int]] = [(0, 0, 0.0, len(text))] * (len(text) + 1)
    for i in range(len(text) - 1, -1, -1):
        rest = best[i + 1]
        choices = [(rest[0] + 1, rest[1] + 1, rest[2], i + 1)]
        for j, weight in trie.words_at(text, i):
            rest = best[j]
            choices.append((rest[0], rest[1] + 1, rest[2] - weight, j))
        best[i] = min(choices, key=lambda c: (c[0], c[1], round(c[2], 9), -c[3]))
    out, i = [], 0
    while i < len(text):
        out.append(text[i:best[i][3]])
        i = best[i][3]
    return out


def words_in(text: str | None, trie: Trie, spaced: bool = False) -> list[str]:
    """Words of a text, lower case: runs of letters and digits; stretches of scripts without blanks are cut by the dictionary.

    ``spaced`` cuts stretches of all scripts, as for texts that have lost their blanks.
    """
    out: list[str] = []
    for run in _RUN.findall((text or "").lower()):
        for part in _PART.findall(run):
            out += best_path(part, trie) if spaced or re.match(f"[{UNSPACED}]", part) else [part]
    return out


class Cutter:
    """Best paths (:func:`best_path`) of many stretches at once.

    The words at all places are found together, letter by letter. No path need look past a place that no word of the dictionary reaches
    across, so a stretch falls into short pieces there.
    """

    def __init__(self, words: dict[str, float]):
        letters = sorted({ord(c) for word in words for c in word})
        self.size = len(letters) + 1
        self.letter = np.zeros(max(letters, default=0) + 2, np.int64)
        self.letter[letters] = np.arange(1, self.size)
        nodes, steps = {"": 0}, {}
        for word in words:
            for k in range(len(word)):
                if word[:k + 1] not in nodes:
                    nodes[word[:k + 1]] = len(nodes)
                    steps[nodes[word[:k]] * self.size + int(self.letter[ord(word[k])])] = nodes[word[:k + 1]]
        self.steps = np.array(sorted(steps), np.int64)
        self.targets = np.array([steps[k] for k in self.steps.tolist()], np.int64)
        self.first = np.full(self.size, -1, np.int64)
        roots = self.steps < self.size
        self.first[self.steps[roots]] = self.targets[roots]
        self.table = None
        if len(nodes) * self.size <= TABLE:
            self.table = np.full(len(nodes) * self.size, -1, np.int32)
            self.table[self.steps] = self.targets
        self.weight = np.full(len(nodes), np.nan)
        for word, weight in words.items():
            self.weight[nodes[word]] = weight

    def _follow(self, step: np.ndarray) -> np.ndarray:
        if self.table is not None:
            return self.table[step].astype(np.int64)
        place = np.minimum(np.searchsorted(self.steps, step), len(self.steps) - 1)
        return np.where(self.steps[place] == step, self.targets[place], -1)

    def words_at(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin, end and weight of each word of the dictionary in a text, by begin and then by end."""
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        letters = self.letter[np.minimum(codes, len(self.letter) - 1)]
        node = self.first[letters]
        at = np.flatnonzero(node >= 0)
        node, length, found = node[at], 1, []
        while len(at):
            is_word = ~np.isnan(self.weight[node])
            found.append((at[is_word], at[is_word] + length, self.weight[node[is_word]]))
            inside = at + length < len(letters)
            at, node = at[inside], node[inside]
            node = self._follow(node * self.size + letters[at + length])
            on = node >= 0
            at, node, length = at[on], node[on], length + 1
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        begins, ends, weights = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(begins, kind="stable")
        return begins[order], ends[order], weights[order]

    def cut(self, parts: list[str]) -> list[list[str]]:
        """The best path of each stretch."""
        text = "\n".join([*parts, ""])
        begins, ends, weights = self.words_at(text)
        reach = np.arange(1, len(text) + 1)
        np.maximum.at(reach, begins, ends)
        is_word = np.ones(len(text) + 1, bool)
        is_word[1:-1] = np.maximum.accumulate(reach)[:-1] <= np.arange(1, len(text))
        if len(text):
            _mark_words(is_word, begins, ends, weights)
        places = np.flatnonzero(is_word).tolist()
        words = [text[a:b] for a, b in zip(places, places[1:])]
        out: list[list[str]] = [[] for _ in parts]
        i = 0
        for path in out:
            end = words.index("\n", i)
            path += words[i:end]
            i = end + 1
        return out

    def words_in(self, texts: list[str | None], spaced: bool = False) -> list[list[str]]:
        """Words of each text, as :func:`words_in`."""
        out: list[list[str]] = []
        block: list[list[str]] = []
        size = 0
        for text in texts:
            block.append([part for run in _RUN.findall((text or "").lower()) for part in _PART.findall(run)])
            size += len(text or "")
            if size >= BLOCK:
                out += self._cut_block(block, spaced)
                block, size = [], 0
        return out + self._cut_block(block, spaced)

    def arrays(self, texts: pa.Array, spaced: bool = False) -> pa.Array:
        """Lists of the words of each text of an Arrow array. Only the words of a block of them are Python objects at a time."""
        ends = np.cumsum(pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False))
        kind, out, lo = pa.list_(pa.string()), [], 0
        while lo < len(texts):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + BLOCK, "right")))
            out.append(pa.array(self.words_in(texts.slice(lo, hi - lo).to_pylist(), spaced), kind))
            lo = hi
        return pa.concat_arrays(out) if out else pa.array([], kind)

    def _cut_block(self, block: list[list[str]], spaced: bool) -> list[list[str]]:
        to_cut = [spaced or _UNSPACED.match(part) is not None for parts in block for part in parts]
        paths = iter(self.cut([part for part, yes in zip((p for parts in block for p in parts), to_cut) if yes]))
        flags = iter(to_cut)
        return [[word for part in parts for word in (next(paths) if next(flags) else (part,))] for parts in block]


def _mark_words(is_word: np.ndarray, begins: np.ndarray, ends: np.ndarray, weights: np.ndarray) -> None:
    """Mark where the words of the best paths begin, given where the pieces begin that no word reaches out of.

    All pieces are worked through together from their ends, a letter at a time; the few longest, which would keep so many steps busy with little, alone.
    """
    piece = np.cumsum(is_word) - 1
    bounds = np.flatnonzero(is_word)
    sizes = np.diff(bounds)
    order = np.argsort(-sizes, kind="stable")
    order = order[:np.count_nonzero(sizes > 1)]
    starts, stops, sizes = bounds[order], bounds[order + 1], sizes[order]
    first = np.concatenate([[0], np.cumsum(np.bincount(begins, minlength=len(piece)))])
    # A piece has a cell for its end, too, which costs nothing from there on.
    cells = ends + piece[begins]
    price, weight = np.zeros(len(piece) + len(bounds), np.int64), np.zeros(len(piece) + len(bounds))
    step = np.arange(1, len(piece) + 1)
    alone = min(FEW, len(sizes))
    for start, stop in zip(starts[:alone].tolist(), stops[:alone].tolist()):
        low, high = first[start], first[stop]
        step[start:stop] = _cheapest(stop - start, (first[start:stop + 1] - low).tolist(), (ends[low:high] - start).tolist(),
                                     weights[low:high].tolist()) + start
    lasts, longest = stops[alone:], sizes[alone:]
    for t in range(1, int(longest[0]) + 1 if len(longest) else 1):
        at = lasts[:np.searchsorted(-longest, -t, "right")] - t
        cell = at + piece[at]
        c, w, k = price[cell + 1] + _OUTSIDE + 1, weight[cell + 1], at + 1
        x, some = first[at], first[at + 1] - first[at]
        on, r = np.flatnonzero(some), 0
        while len(on):
            word = x[on] + r
            cj, wj = price[cells[word]] + 1, weight[cells[word]] - weights[word]
            better = (cj < c[on]) | ((cj == c[on]) & (np.round(wj, 9) <= np.round(w[on], 9)))
            hit, word = on[better], word[better]
            c[hit], w[hit], k[hit] = cj[better], wj[better], ends[word]
            r += 1
            on = on[some[on] > r]
        price[cell], weight[cell], step[at] = c, w, k
    while len(starts):
        starts = step[starts]
        inside = starts < stops
        starts, stops = starts[inside], stops[inside]
        is_word[starts] = True


def _cheapest(n: int, first: list[int], ends: list[int], weights: list[float]) -> np.ndarray:
    """Where the next word begins on the best path from each of ``n`` places, by the words that begin there."""
    price, weight, step = [0] * (n + 1), [0.0] * (n + 1), [0] * n
    for i in range(n - 1, -1, -1):
        c, w, k = price[i + 1] + _OUTSIDE + 1, weight[i + 1], i + 1
        for x in range(first[i], first[i + 1]):
            j = ends[x]
            cj, wj = price[j] + 1, weight[j] - weights[x]
            if cj < c or (cj == c and round(wj, 9) <= round(w, 9)):
                c, w, k = cj, wj, j
        price[i], weight[i], step[i] = c, w, k
    return np.array(step, np.int64)


def dictionary(words: DataFrame, word: str = "word", weight: str | None = None) -> dict[str, float]:
    """The words of a table (lower case, with their weights or 0) for :func:`segmented`; a table beyond ``MAX_WORDS`` is refused."""
    value = F.lit(0.0) if weight is None else F.col(weight).cast("double")
    rows = words.select(F.lower(word).alias("w"), value.alias("v")).where("w <> ''").groupBy("w").agg(F.max("v").alias("v"))
    found = rows.limit(MAX_WORDS + 1).toArrow()
    if found.num_rows > MAX_WORDS:
        raise ValueError(f"a dictionary has at most {MAX_WORDS} words")
    return dict(zip(found["w"].to_pylist(), found["v"].to_pylist()))


def segmented(text: Column | str, words: dict[str, float], spaced: bool = False) -> Column:
    """Array of the words of a text (see :func:`words_in`), worked out on Arrow batches."""
    made: list[Cutter] = []

    @F.arrow_udf(ArrayType(StringType()))
    def cut(texts: pa.Array) -> pa.Array:
        if not made:
            made.append(Cutter(words))
        return made[0].arrays(texts, spaced)

    return cut(F.col(text) if isinstance(text, str) else text)


def segmented_words_of(df: DataFrame, text: str, keep: list[str | Column], words: dict[str, float], spaced: bool = False) -> DataFrame:
    """One row per word of ``text``, as :func:`marketlens.operators.joins.words_of` with a dictionary."""
    return df.select(*keep, F.explode(segmented(text, words, spaced)).alias("word"))
