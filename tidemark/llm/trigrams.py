"""Boolean trigram queries of regular expressions.

A query is a conjunction of alternatives: for each, at least one of some strings has to be in a matching text, and a string can only
be there if all its trigrams are. Everything is in lower case, as the index is. A regular expression from which nothing
can be derived gives an empty conjunction, and its rule has to scan every text.
"""

from __future__ import annotations

from re import _constants as kinds
from re import _parser as parser

# An alternative of more strings than this, or a character class of more characters, tells too little to be kept.
MOST_STRINGS = 64
MOST_CHARACTERS = 8


def trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def query_of(pattern: str) -> tuple[frozenset[str], ...]:
    """The alternatives of a pattern, each a set of strings of three characters or more."""
    required, exact = _walk(parser.parse(pattern))
    return tuple(dict.fromkeys([*required, *_closed(exact)]))


def _closed(exact: frozenset[str] | None) -> list[frozenset[str]]:
    """The alternative that a finished run of strings makes, unless one of them is too short to have a trigram."""
    if not exact or any(len(s) < 3 for s in exact):
        return []
    # A string that holds another one of them adds nothing.
    return [frozenset(s for s in exact if not any(t != s and t in s for t in exact))]


def _walk(nodes) -> tuple[list[frozenset[str]], frozenset[str] | None]:
    """Alternatives that a sequence requires besides its own strings, and those strings if they can be listed."""
    required: list[frozenset[str]] = []
    run: frozenset[str] | None = frozenset([""])
    whole = True  # whether the run holds everything matched so far
    for kind, value in nodes:
        inner, strings = _node(kind, value)
        required += inner
        joined = frozenset(a + b for a in run for b in strings) if strings is not None else None
        if joined is not None and len(joined) <= MOST_STRINGS:
            run = joined
            continue
        required += _closed(run)
        whole = False
        run = strings if strings is not None and len(strings) <= MOST_STRINGS else frozenset([""])
    if whole:
        return required, run
    return required + _closed(run), None


def _node(kind, value) -> tuple[list[frozenset[str]], frozenset[str] | None]:
    if kind is kinds.LITERAL:
        return [], frozenset([chr(value).lower()])
    if kind is kinds.IN:
        listed = [chr(v).lower() for k, v in value if k is kinds.LITERAL]
        plain = len(listed) == len(value) and len(listed) <= MOST_CHARACTERS
        return [], frozenset(listed) if plain else None
    if kind is kinds.SUBPATTERN:
        return _walk(value[3])
    if kind is kinds.AT or kind is kinds.ASSERT or kind is kinds.ASSERT_NOT:
        return [], frozenset([""])
    if kind is kinds.BRANCH:
        branches = [_walk(b) for b in value[1]]
        if all(strings is not None for _, strings in branches):
            return [], frozenset().union(*[strings for _, strings in branches])
        # Each branch must offer one alternative of its own; the first is taken.
        offers = [(inner + _closed(strings))[:1] if strings is None else _closed(strings) for inner, strings in branches]
        return [frozenset().union(*[o[0] for o in offers])] if all(offers) else [], None
    if kind in (kinds.MAX_REPEAT, kinds.MIN_REPEAT):
        least, most, inner = value
        if least == 0:
            strings = _walk(inner)[1] if most == 1 else None
            return [], strings | {""} if strings is not None else None
        required, strings = _walk(inner)
        if least == most and strings is not None and len(strings) ** least <= MOST_STRINGS:
            repeated = frozenset([""])
            for _ in range(least):
                repeated = frozenset(a + b for a in repeated for b in strings)
            return required, repeated
        return required + (_closed(strings) if strings is not None else []), None
    return [], None
