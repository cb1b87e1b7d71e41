"""Boolean trigram queries of regular expressions: what a text must hold for the expression to match in it.

A query is True (nothing can be demanded), a trigram in lower case, or ("all" | "any", queries). It is derived from the
expression alone, by the tree that Python's own parser makes of it: pieces that can only be a few strings are put
together into longer strings, whose trigrams a match must hold; anything else ends such a run. Expressions must mean the
same to Python and to Java. Only ASCII letters count, as engines differ in the small letters of others.
"""

from __future__ import annotations

import re
from re import _constants as op
from re import _parser

Query = bool | str | tuple

#: Strings that a run is kept apart into, at most; more of them end the run.
MOST = 64
REPEATS = (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT)


def every(queries: list[Query]) -> Query:
    return _put(True, "all", queries)


def either(queries: list[Query]) -> Query:
    return True if True in queries else _put(False, "any", queries)


def implies(a: Query, b: Query) -> bool:
    """Does every text that meets a plainly meet b?"""
    if b is True or a == b:
        return True
    kind = lambda q: q[0] if isinstance(q, tuple) else ""
    if kind(a) == "any":
        return all(implies(x, b) for x in a[1])
    if kind(b) == "all":
        return all(implies(a, y) for y in b[1])
    return kind(a) == "all" and any(implies(x, b) for x in a[1]) or kind(b) == "any" and any(implies(a, y) for y in b[1])


def _put(nothing: bool, kind: str, queries: list[Query]) -> Query:
    flat: list[Query] = []
    for q in queries:
        flat += q[1] if isinstance(q, tuple) and q[0] == kind else [q]
    kept = sorted({q for q in flat if q is not True}, key=repr)
    # What another one says already goes; of two that say the same the first stays.
    says = (lambda x, y: implies(y, x)) if kind == "all" else implies
    for q in list(kept):
        if any(says(q, other) and not (says(other, q) and kept.index(q) < kept.index(other)) for other in kept if other != q):
            kept.remove(q)
    return nothing if not kept else kept[0] if len(kept) == 1 else (kind, tuple(kept))


def _held(strings: set[str]) -> Query:
    """The trigrams of one of the strings, which a text with one of them holds."""
    return either([every([s[i : i + 3] for i in range(len(s) - 2)]) for s in strings])


def _members(items: list) -> set[str] | None:
    """The strings that a class of characters stands for, None if they aren't few ASCII characters."""
    out: set[str] = set()
    for kind, value in items:
        if kind is op.LITERAL:
            out.add(chr(value).lower())
        elif kind is op.RANGE and value[1] < 128:
            out.update(chr(c).lower() for c in range(value[0], value[1] + 1))
        else:
            return None
    return out if len(out) <= MOST and all(s.isascii() for s in out) else None


def _piece(kind, value) -> tuple[set[str] | None, Query]:
    """(all strings that an element can match, or None if they aren't few; what any of its matches demands)."""
    if kind is op.LITERAL:
        return _members([(kind, value)]), True
    if kind is op.IN:
        return _members(value), True
    if kind in (op.AT, op.ASSERT, op.ASSERT_NOT):
        return {""}, True
    if kind is op.SUBPATTERN:
        return _sequence(value[-1])
    if kind is op.ATOMIC_GROUP:
        return _sequence(value)
    if kind is op.BRANCH:
        parts = [_sequence(x) for x in value[1]]
        strings = None if any(s is None for s, _ in parts) else set().union(*(s for s, _ in parts))
        return strings if strings and len(strings) <= MOST else None, either([q for _, q in parts])
    if kind in REPEATS:
        least, most, body = value
        strings, need = _sequence(body)
        if strings is None or most > 4:
            row = _powers(strings, min(least, 4)) if strings is not None and least else None
            return None, every([need, _held(row)]) if row else need if least else True
        rows = [_powers(strings, n) for n in range(least, int(most) + 1)]
        all_of = None if None in rows else set().union(*rows)
        return all_of if all_of and len(all_of) <= MOST else None, need if least else True
    return None, True


def _powers(strings: set[str], n: int) -> set[str] | None:
    """n of the strings in a row, None if those are too many."""
    out = {""}
    for _ in range(n):
        if len(out) * len(strings) > MOST:
            return None
        out = {a + b for a in out for b in strings}
    return out


def _sequence(items) -> tuple[set[str] | None, Query]:
    run, needs, whole = {""}, [], True
    for kind, value in items:
        strings, need = _piece(kind, value)
        needs.append(need)
        if strings is None:
            needs.append(_held(run))
            run, whole = {""}, False
            continue
        longer = {a + b for a in run for b in strings}
        if len(longer) > MOST:  # go on from the last two letters, which the next trigrams begin in
            needs.append(_held(run))
            longer, whole = {a[-2:] + b for a in run for b in strings}, False
            if len(longer) > MOST:
                longer = strings
        run = longer
    needs.append(_held(run))
    return run if whole else None, every(needs)


def derive(regex: str) -> Query:
    """The query of a regular expression; True if it has no mandatory trigram."""
    return _sequence(_parser.parse(regex, re.ASCII))[1]


def named(query: Query) -> set[str]:
    """The trigrams that a query names."""
    if isinstance(query, tuple):
        return set().union(*(named(q) for q in query[1]))
    return {query} if isinstance(query, str) else set()


def holds(query: Query, text: str) -> bool:
    """Does a text in lower case meet the query?"""
    if isinstance(query, tuple):
        return (all if query[0] == "all" else any)(holds(q, text) for q in query[1])
    return query if isinstance(query, bool) else query in text
