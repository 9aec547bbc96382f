"""Rows for the operators on texts: near copies, shared lines, hot rows and all edge cases."""

from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words string, seeds int, n int"


def word(rng, n=2):
    return "".join(rng.choice(["the", "on", "er", "ti", "ha", "st", "and", "ou", "re", "ble"]) for _ in range(rng.randint(1, n)))


def text_of(rng, n):
    return " ".join(word(rng, 3) for _ in range(n))


def edge_rows():
    """Null and empty texts, null and repeated ids, blanks only, other blanks, long words, a long text."""
    rng = random.Random(5)
    return [(1, None), (2, ""), (3, " \n\t \x0b\r"), (None, "one two three four five six"), (None, None), (4, "short"),
            (5, "a b c"), (6, "repeated row of words here\nand one more line of it"),
            (6, "repeated row of words here\nand one more line of it"), (6, "same id with another text"),
            (7, "nb\u00a0sp \u3000wide \u0085 x\x1cy é\u0301 \U0001f600 İΣ"), (8, "x" * 5000), (9, text_of(rng, 30_000)),
            (10, "tab\tand\r\nline ends\n\n\nlast")]


def rows_for(seed=3, n=120):
    """Texts with exact and near copies, shared lines and a hot text."""
    rng = random.Random(seed)
    lines = [text_of(rng, 12) for _ in range(8)]
    rows, base = [], []
    for i in range(n):
        kind = rng.random()
        if base and kind < 0.25:
            text = rng.choice(base)
        elif base and kind < 0.5:
            w = rng.choice(base).split(" ")
            for _ in range(rng.randint(1, 3)):
                w[rng.randrange(len(w))] = word(rng)
            text = " ".join(w)
        else:
            text = text_of(rng, rng.randint(5, 120))
            base.append(text)
        if rng.random() < 0.3:
            text = "\n".join([rng.choice(lines), text, "  " + rng.choice(lines).upper() + "\t"])
        rows.append((1000 + i, text))
    return rows + [(2000 + i, base[0]) for i in range(n // 2)]


def rng_lang(i):
    return None if i is None or i % 7 == 0 else "en" if i % 2 else "de"


def words_of(text):
    return [] if text is None else [w.decode() for w in text.encode().split()]


def folded(text):
    return [] if text is None else [w.decode() for w in text.encode().lower().split()]


@pytest.fixture(scope="session")
def corpus(spark):
    """Rows of both kinds, with further columns whose names operators use themselves."""
    rows = [(i, t, rng_lang(i), "s", None if t is None else len(t), "w", 1, 2) for i, t in rows_for() + edge_rows()]
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    """The same columns without rows."""
    return spark.createDataFrame([], SCHEMA)
