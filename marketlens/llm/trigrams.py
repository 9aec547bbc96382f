"""Trigram queries of regular expressions: which trigrams a text must hold if an expression matches in it.

A query is a list of clauses that must all hold; a clause is a list of alternatives, of which one must hold; an
alternative is a set of trigrams that must all occur in the lower-cased text. No clause: the text must be scanned.
"""

from __future__ import annotations

from re import _parser as parser  # the parse tree of the standard library's own expressions

Query = list[list[frozenset[str]]]
MOST_STRINGS = 64
MOST_CHARS_OF_A_SET = 8


def trigram_query(pattern: str) -> Query:
    """The query of a pattern, as weak as need be to hold for every match."""
    exact, query = _walk(parser.parse(pattern))
    return _simplify(query + _clause(exact))


def _clause(strings: set[str] | None) -> Query:
    """The condition that one of the strings occurs; none if one of them is too short to have a trigram."""
    if not strings or min(map(len, strings)) < 3:
        return []
    return [[frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings]]


def _simplify(query: Query) -> Query:
    out = []
    for clause in query:
        kept = {a for a in clause if not any(b < a for b in clause)}
        ordered = sorted(kept, key=sorted)
        if ordered not in out:
            out.append(ordered)
    return out


def _walk(nodes) -> tuple[set[str] | None, Query]:
    """All strings the nodes match, lower-cased, if these are few; and the clauses of what was matched before."""
    current: set[str] = {""}
    query: Query = []
    for op, value in nodes:
        strings, inner = _one(str(op), value)
        query += inner
        joined = None if strings is None else {a + b for a in current for b in strings}
        if joined is not None and len(joined) <= MOST_STRINGS:
            current = joined
        else:
            query += _clause(current)
            current = strings if strings is not None and joined is not None else {""}
    whole = not query and all(_one(str(o), v)[0] is not None for o, v in nodes)
    return (current, query) if whole else (None, query + _clause(current))


def _one(op: str, value) -> tuple[set[str] | None, Query]:
    if op == "LITERAL":
        return {chr(value).lower()}, []
    if op == "IN":
        chars = set()
        for kind, v in value:
            if str(kind) == "LITERAL":
                chars.add(chr(v).lower())
            elif str(kind) == "RANGE" and v[1] - v[0] < MOST_CHARS_OF_A_SET:
                chars |= {chr(c).lower() for c in range(v[0], v[1] + 1)}
            else:
                return None, []
        return (chars, []) if len(chars) <= MOST_CHARS_OF_A_SET else (None, [])
    if op == "SUBPATTERN":
        return _walk(value[3])
    if op == "AT":
        return {""}, []
    if op == "BRANCH":
        parts = [_walk(p) for p in value[1]]
        if all(s is not None and not q for s, q in parts):
            strings = set().union(*[s for s, _ in parts])
            if len(strings) <= MOST_STRINGS:
                return strings, []
        needed = [q + _clause(s) for s, q in parts]
        return None, ([[a for q in needed for a in q[0]]] if all(needed) else [])
    if op in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
        least, most, inner = value
        strings, query = _walk(inner)
        if strings is not None and not query and most <= 3 and len(strings) ** most <= MOST_STRINGS:
            out, power = set(), {""}
            for k in range(int(most) + 1):
                out |= power if k >= least else set()
                power = {a + b for a in power for b in strings}
            return out, []
        return None, (query + _clause(strings) if least else [])
    return None, []

