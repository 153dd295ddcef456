"""Boolean trigram queries derived from regular expressions.

``trigram_query(pattern)`` gives a condition that every text with a match fulfils, over the trigrams of the text's
lower case: a trigram, ``("and", parts)``, ``("or", parts)``, or ``ANY`` where nothing is mandatory.
"""

from __future__ import annotations

from re import _constants as sre
from re import _parser as sre_parser

ANY = ("and", ())
#: A set of exact strings is kept apart while it has so many members at most, a character class so many characters.
MOST_STRINGS, MOST_CHARS = 64, 8


def _both(*parts):
    """All of the parts, flat and without repeats."""
    flat = []
    for p in parts:
        for x in p[1] if isinstance(p, tuple) and p[0] == "and" else (p,):
            if x not in flat:
                flat.append(x)
    return flat[0] if len(flat) == 1 else ("and", tuple(flat))


def _either(parts):
    """One of the parts at least; nothing is mandatory if one of them demands nothing."""
    flat = []
    for p in parts:
        if p == ANY:
            return ANY
        for x in p[1] if isinstance(p, tuple) and p[0] == "or" else (p,):
            if x not in flat:
                flat.append(x)
    needs = [frozenset(x[1]) if isinstance(x, tuple) and x[0] == "and" else frozenset([x]) for x in flat]
    flat = [x for x, n in zip(flat, needs, strict=True) if not any(m < n for m in needs)]  # what demands more adds nothing
    return flat[0] if len(flat) == 1 else ("or", tuple(flat))


def _of_strings(strings) -> tuple | str:
    """One of these strings is in the text."""
    return _either([_both(*[s[i : i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def _chars(items) -> set[str] | None:
    """The characters of a class in lower case; None if it is too wide."""
    found: set[str] = set()
    for op, arg in items:
        if op is sre.LITERAL:
            found.add(chr(arg).lower())
        elif op is sre.RANGE and arg[1] - arg[0] < 2 * MOST_CHARS:
            found |= {chr(c).lower() for c in range(arg[0], arg[1] + 1)}
        else:
            return None
    return found if len(found) <= MOST_CHARS else None


class _Walk:
    """What a sequence demands: the query so far, and the exact strings that its last part can be."""

    def __init__(self):
        self.query, self.exact = ANY, {""}

    def flush(self):
        self.query, self.exact = _both(self.query, _of_strings(self.exact)), {""}

    def extend(self, strings: set[str]):
        longer = {a + b for a in self.exact for b in strings}
        if len(longer) > MOST_STRINGS:
            self.flush()
            longer = strings
        self.exact = longer

    def sequence(self, items) -> None:
        for op, arg in items:
            if op is sre.LITERAL:
                self.extend({chr(arg).lower()})
            elif op is sre.IN and (chars := _chars(arg)):
                self.extend(chars)
            elif op is sre.SUBPATTERN:
                self.sequence(arg[3])
            elif op is sre.BRANCH:
                self.branch(arg[1])
            elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
                self.repeat(*arg)
            elif op is sre.AT or op in (sre.ASSERT, sre.ASSERT_NOT):
                continue
            else:
                self.flush()

    def branch(self, branches) -> None:
        walks = []
        for b in branches:
            w = _Walk()
            w.sequence(b)
            walks.append(w)
        if all(w.query == ANY and w.exact != {""} for w in walks) and sum(len(w.exact) for w in walks) <= MOST_STRINGS:
            self.extend(set().union(*[w.exact for w in walks]))
        else:
            self.flush()
            self.query = _both(self.query, _either([_both(w.query, _of_strings(w.exact)) for w in walks]))

    def repeat(self, least, most, items) -> None:
        w = _Walk()
        w.sequence(items)
        simple = w.query == ANY and w.exact != {""} and len(w.exact) <= MOST_CHARS
        if (least, most) == (0, 1) and simple:
            self.extend(w.exact | {""})
        elif least and simple:
            for _ in range(min(least, 3)):
                self.extend(w.exact)
            if (least, most) != (min(least, 3),) * 2:
                self.flush()
        else:
            self.flush()
            if least:
                self.query = _both(self.query, w.query, _of_strings(w.exact))


def trigram_query(pattern: str):
    """The Boolean trigram query of a regular expression in the syntax that Python and Java share."""
    walk = _Walk()
    walk.sequence(sre_parser.parse(pattern))
    walk.flush()
    return walk.query


def trigrams_of(query) -> list[str]:
    """The query's distinct trigrams, sorted."""
    return [query] if isinstance(query, str) else sorted({t for p in query[1] for t in trigrams_of(p)})
