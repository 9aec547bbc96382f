"""Token ids of texts by a public tokenizer, with memos of words and their pieces.

Splitting a text where the tokenizer itself always splits, and keeping the ids of the pieces seen so far, gives the ids of
the whole text: between a run of letters and digits and what stands beside it, except that an apostrophe stays with
the letters after it, and around white space.
"""

from __future__ import annotations

import os
import re
import unicodedata
from array import array
from collections.abc import Callable

import numpy as np

MEMO = 1 << 19
_SPACED = re.compile(r" ?[^\W_]+| ?(?:[^\w\s]|_)*'[^\W_]+| ?(?:[^\w\s]|_)+|\s+(?!\S)|\s")
_BARE = re.compile(r"[^\W_]+|(?:[^\w\s]|_)*'[^\W_]+|(?:[^\w\s]|_)+")
_SEPARATORS = re.compile("[\x1c-\x1f]")  # white space to Python only
_RARE_BLANKS = re.compile("[\x1c-\x1f\t\x0b\x0c\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_BEYOND_LATIN = re.compile("[^\x00-\u024f]")
_RUNS = ("  ", " \n", "\n ", "\n\n")
_GAPS = re.compile(r"(\A[ \n]+|[ \n]{2,}|[ \n]+\Z)")  # blanks that are not one between two words
_SHOWN = {*range(33, 127), *range(161, 173), *range(174, 256)}  # bytes that byte-level pieces show as they are
_BYTE_CHARS = dict(zip(sorted(set(range(256)) - _SHOWN), range(256, 512)))
_encoders: dict[tuple[str, bool], Callable[[str], bytes]] = {}


def encoder(path: str, spaced: bool) -> Callable[[str], bytes]:
    """A function from a text to its ids as little-endian 32-bit integers, kept for the life of the worker.

    ``spaced``: the tokenizer keeps white space as byte-level pieces; otherwise it drops white space, composes
    characters (NFC) and lower-cases. Strings of special tokens are ordinary text. The memos start anew before
    a text once they hold more than ``MEMO`` entries, never within one, so they hold that many and those of one text at most.
    """
    if (path, spaced) not in _encoders:
        _encoders[path, spaced] = _make(path, spaced)
    return _encoders[path, spaced]


def _make(path: str, spaced: bool) -> Callable[[str], bytes]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(path)
    tool.encode_special_tokens = True
    find = (_SPACED if spaced else _BARE).findall
    mark = "\n" if spaced else " | "  # between pieces that are encoded together; a token of its own

    def ids(text: str) -> np.ndarray:
        return np.array(tool.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    tokenize = tool.model.tokenize
    blank = chr(_BYTE_CHARS[32])
    mark_id = ids(mark)[0]
    pieces: dict[str, bytes] = {}
    heads: dict[str, bytes] = {}
    tails: dict[str, bytes] = {}

    def word(p: str) -> bytes:
        """Ids of letters, maybe after a blank, which stay as they are where they are ASCII."""
        if not p.isascii():
            p = p.encode().decode("latin-1").translate(_BYTE_CHARS)
        elif p[0] == " ":
            p = blank + p[1:]
        return array("I", [t.id for t in tokenize(p)]).tobytes()

    def learn(new: set[str]) -> None:
        together = []
        for p in new:
            if p.lstrip(" ").isalpha():  # one piece to the tokenizer as well: its model alone is faster
                pieces[p] = word(p)
            elif mark.strip(" ") in p or p.isspace():
                pieces[p] = ids(p).tobytes()
            else:
                together.append(p)
        if together:
            found = ids(mark.join(together))
            at = np.flatnonzero(found == mark_id)
            cuts = [0, *(at + 1).tolist()]
            for p, a, b in zip(together, cuts, [*at.tolist(), len(found)], strict=True):
                pieces[p] = found[a:b].tobytes()

    def slow(texts: list[str]) -> list[bytes]:
        found = [find(t) for t in texts]
        new = {p for x in found for p in x if p not in pieces}
        if new:
            learn(new)
        return [b"".join([pieces[p] for p in x]) for x in found]

    def keep(memo: dict[str, bytes], chunks: list[str], prefix: str) -> None:
        mixed = []
        for c in {c for c in chunks if c not in memo}:
            if c.isalpha():
                memo[c] = word(prefix + c)
            else:
                mixed.append(c)
        memo.update(zip(mixed, slow([prefix + c for c in mixed] if prefix else mixed), strict=True))

    def by_chunk(text: str) -> bytes:
        if not spaced:
            chunks = text.split()
            try:
                return b"".join(map(tails.__getitem__, chunks))
            except KeyError:
                keep(tails, chunks, "")
                return b"".join(map(tails.__getitem__, chunks))
        return words_of(text, False)

    def words_of(text: str, after_blank: bool) -> bytes:
        lines = [line.split(" ") for line in text.split("\n")]
        try:
            return joined(lines, after_blank)
        except KeyError:
            keep(heads, [x[0] for x in lines], "")
            keep(tails, [c for x in lines for c in x[1:]] + lines[0][:1] * after_blank, " ")
            return joined(lines, after_blank)

    def joined(lines: list[list[str]], after_blank: bool) -> bytes:
        found = [heads[x[0]] + b"".join(map(tails.__getitem__, x[1:])) for x in lines]
        if after_blank:
            found[0] = b"".join(map(tails.__getitem__, lines[0]))
        return line_end.join(found)

    def blanks(run: str) -> bytes:
        if run and run not in pieces:
            pieces[run] = ids(run).tobytes()
        return pieces[run] if run else b""

    def with_gaps(text: str) -> bytes:
        """A run of blanks is one piece at the end; before a word its last blank goes with the word, or is a piece if a line end."""
        parts, out, after_blank = _GAPS.split(text), [], False
        for k in range(0, len(parts), 2):
            if parts[k]:
                out.append(words_of(parts[k], after_blank))
            if k + 1 < len(parts):
                run = parts[k + 1]
                last = k + 2 == len(parts) - 1 and not parts[k + 2]
                after_blank = not last and run[-1] == " "
                out.append(blanks(run) if last else blanks(run[:-1]) + (b"" if after_blank else line_end))
        return b"".join(out)

    line_end = mark_id.tobytes()

    def newer(text: str) -> bool:
        """Whether a character is not known here, so that the tokenizer may know it as a letter or digit."""
        return (not text.isascii() and bool(_BEYOND_LATIN.search(text))
                and any(unicodedata.category(c) == "Cn" for c in set(text)))

    def encode(text: str) -> bytes:
        if not text:
            return b""
        for memo in (pieces, heads, tails):
            if len(memo) > MEMO:
                memo.clear()
        if newer(text):
            return ids(text).tobytes()
        if not spaced:
            if _SEPARATORS.search(text):
                return ids(text).tobytes()
            if not text.isascii():
                text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
            return by_chunk(text.lower())
        if _RARE_BLANKS.search(text):
            return ids(text).tobytes() if _SEPARATORS.search(text) else slow([text])[0]
        if text[0] in " \n" or text[-1] in " \n" or any(r in text for r in _RUNS):
            return with_gaps(text)
        return by_chunk(text)

    return encode
