"""Boolean trigram queries of regular expressions.

A query is a set of alternatives, each a set of trigrams: a text the expression matches holds every trigram of one of
them. Letters are folded to lower case on both sides. No alternative at all (`ANY`) says that nothing is mandatory.
"""

from __future__ import annotations

from itertools import product
from re import _constants as C
from re import _parser as P

#: Strings, and alternatives, that a part of an expression may stand for before it is given up as unknown.
MOST = 16

Query = frozenset[frozenset[str]]
#: Every text may match: the conjunction of nothing.
ANY: Query = frozenset([frozenset()])


def trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _simple(query: Query) -> Query:
    """Without alternatives that ask for more than another one does."""
    return frozenset(a for a in query if not any(b < a for b in query))


def _or(queries: list[Query]) -> Query:
    found = _simple(frozenset().union(*queries))
    return found if len(found) <= MOST else ANY


def _and(a: Query, b: Query) -> Query:
    found = _simple(frozenset(x | y for x, y in product(a, b)))
    return found if len(found) <= MOST else max(a, b, key=lambda q: min(map(len, q)))


def _of_strings(strings: frozenset[str]) -> Query:
    return _or([frozenset([trigrams(s)]) for s in strings])


def _members(items: list) -> frozenset[str] | None:
    """Characters of a class, None if there are too many of them."""
    found: set[str] = set()
    for kind, value in items:
        if kind is C.LITERAL:
            found.add(chr(value).lower())
        elif kind is C.RANGE and value[1] - value[0] < MOST:
            found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return frozenset(found) if len(found) <= MOST else None


def _strings(item: tuple) -> frozenset[str] | None:
    """All strings a part can match, None where they are unknown or too many."""
    kind, value = item
    if kind is C.LITERAL:
        return frozenset([chr(value).lower()])
    if kind is C.IN:
        return _members(value)
    if kind is C.SUBPATTERN:
        return _joined(value[-1])
    if kind is C.BRANCH:
        parts = [_joined(branch) for branch in value[1]]
        if any(p is None for p in parts):
            return None
        found = frozenset().union(*parts)
        return found if len(found) <= MOST else None
    if kind in (C.MAX_REPEAT, C.MIN_REPEAT) and value[1] == 1:
        inner = _joined(value[2])
        if inner is None:
            return None
        return inner if value[0] == 1 else inner | {""}
    return None


def _joined(items) -> frozenset[str] | None:
    made = frozenset([""])
    for item in items:
        part = _strings(item)
        if part is None or len(made) * len(part) > MOST:
            return None
        made = frozenset(a + b for a, b in product(made, part))
    return made


def _query(item: tuple) -> Query:
    """What a part that is no small set of strings asks for by itself."""
    kind, value = item
    if kind is C.SUBPATTERN:
        return _sequence(value[-1])
    if kind is C.BRANCH:
        return _or([_sequence(branch) for branch in value[1]])
    if kind in (C.MAX_REPEAT, C.MIN_REPEAT) and value[0] >= 1:
        return _sequence(value[2])
    return ANY


def _sequence(items) -> Query:
    """Neighbouring parts with known strings are one run of text; others part the runs."""
    found, run = ANY, frozenset([""])
    for item in items:
        part = _strings(item)
        if part is not None and len(run) * len(part) <= MOST:
            run = frozenset(a + b for a, b in product(run, part))
            continue
        found = _and(found, _of_strings(run))
        run = frozenset([""]) if part is None else part
        if part is None:
            found = _and(found, _query(item))
    return _and(found, _of_strings(run))


def of_regex(pattern: str) -> Query:
    """The trigram query of a regular expression; `ANY` if it has no mandatory trigram."""
    found = _sequence(P.parse(pattern))
    return ANY if frozenset() in found else found
