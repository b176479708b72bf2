"""Boolean trigram queries of regular expressions: what a text must contain to match.

A query is None (nothing is known, every text is a candidate) or a list of alternatives, each a
set of trigrams that must all occur. Letters count as lower case, so texts are lower-cased first.
"""

from re import _constants as op
from re import _parser

MOST = 64


def query(pattern):
    return _needs(_concat(_parser.parse(pattern)))


def _any():
    return None, None


def _needs(found):
    """Query of (exact strings or None, query)."""
    exact, known = found
    if exact is None:
        return known
    if any(len(s) < 3 for s in exact):
        return None
    return _least([frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in exact])


def _least(alternatives):
    """Without alternatives that ask for more than another one."""
    kept = []
    for a in sorted(set(alternatives), key=lambda x: (len(x), sorted(x))):
        if not any(b <= a for b in kept):
            kept.append(a)
    return kept


def _both(a, b):
    if a is None or b is None:
        return b if a is None else a
    if len(a) * len(b) > MOST:
        return min(a, b, key=len)
    return _least([x | y for x in a for y in b])


def _concat(items):
    known, run, whole = None, {""}, True
    for item in items:
        exact, other = _node(item)
        joined = None if exact is None else {a + b for a in run for b in exact}
        if joined is not None and len(joined) <= MOST:
            run = joined
            continue
        known, whole = _both(_both(known, _needs((run, None))), _needs((exact, other))), False
        run = {""}
    if whole:
        return run, None
    return None, _both(known, _needs((run, None)))


def _node(item):
    kind, value = item
    if kind is op.LITERAL:
        return {chr(value).lower()}, None
    if kind is op.AT:
        return {""}, None
    if kind is op.IN:
        return _class(value)
    if kind is op.SUBPATTERN:
        return _concat(value[-1])
    if kind is op.BRANCH:
        parts = [_concat(branch) for branch in value[1]]
        if all(exact is not None for exact, _ in parts):
            return set().union(*[exact for exact, _ in parts]), None
        queries = [_needs(part) for part in parts]
        return None, None if None in queries else _least([a for q in queries for a in q])
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT):
        least, most, inner = value
        exact, known = _concat(inner)
        if (least, most) == (0, 1) and exact is not None:
            return exact | {""}, None
        if least == most == 1:
            return exact, known
        return None, _needs((exact, known)) if least else None
    return _any()


def _class(items):
    chars = set()
    for kind, value in items:
        if kind is op.LITERAL:
            chars.add(chr(value).lower())
        else:
            return _any()
    return (chars, None) if len(chars) <= 8 else _any()
