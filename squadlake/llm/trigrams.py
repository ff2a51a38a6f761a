"""The trigrams a text must hold to match a regular expression."""

from __future__ import annotations

from re import _constants as kinds
from re import _parser as parser

#: Alternatives followed apart at most; beyond, what a part demands is forgotten, never what a text may be.
STATES = 64

Clause = frozenset[str]


def trigram_query(pattern: str) -> list[Clause]:
    """Clauses of which any match fulfils one, by holding all its trigrams, in lower case.

    Empty if a match need hold none: then every text is a candidate. Only literals, sets of few
    characters, groups, alternatives and repetitions demand anything.
    """
    states = _sequence(parser.parse(pattern), {(frozenset(), "")})
    clauses = {grams for grams, _ in states}
    if frozenset() in clauses:
        return []
    return sorted((c for c in clauses if not any(o < c for o in clauses)), key=sorted)


def _say(states: set, letters: str) -> set:
    out = set()
    for grams, tail in states:
        for letter in letters:
            said = tail + letter.lower()
            out.add((grams | {said} if len(said) == 3 else grams, said[-2:]))
    return out


def _broken(states: set) -> set:
    return {(grams, "") for grams, _ in states}


def _sequence(items, states: set) -> set:
    for kind, value in items:
        if kind is kinds.LITERAL:
            states = _say(states, chr(value))
        elif kind is kinds.IN and len(value) <= 8 and all(k is kinds.LITERAL for k, _ in value):
            states = _say(states, "".join(chr(v) for _, v in value))
        elif kind is kinds.SUBPATTERN:
            states = _sequence(value[-1], states)
        elif kind is kinds.BRANCH:
            states = set().union(*(_sequence(each, states) for each in value[1]))
        elif kind is kinds.MAX_REPEAT:
            least, most, inner = value
            for _ in range(min(least, 3)):
                states = _sequence(inner, states)
            if (least, most) == (0, 1):
                states = states | _sequence(inner, states)
            elif least != most or least > 3:
                states = _broken(states)
        elif kind is not kinds.AT:
            states = _broken(states)
        if len(states) > STATES:
            states = _broken(states)
            if len(states) > STATES:
                states = {(frozenset.intersection(*(grams for grams, _ in states)), "")}
    return states
