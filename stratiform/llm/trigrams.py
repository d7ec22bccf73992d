"""Boolean trigram queries of regular expressions, and a trigram inverted index to answer them.

The analysis follows the structure of the pattern: a part that can only match few strings is kept as
those strings; where such a part ends, every trigram of each of its strings is mandatory. A query is a
conjunction of clauses, each a disjunction of conjunctions: ``[[{"pas", "ass"}, {"tok", "oke"}], ...]``.
Letters are folded to lower case on both sides, which can only add candidates.
"""

from __future__ import annotations

import re._constants as op
import re._parser as parser

import numpy as np

Clause = list[frozenset[str]]

#: Parts with more strings than this are taken as unknown.
MOST_STRINGS = 64


def trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _clause(strings: set[str]) -> Clause | None:
    """At least one of ``strings`` occurs; None if one of them is too short to say anything."""
    options = [trigrams(s) for s in strings]
    return sorted(set(options), key=sorted) if options and all(options) else None


class _Part:
    """What is known of a piece of a pattern: all its strings, or the clauses that any match meets."""

    def __init__(self, strings: set[str] | None, clauses: list[Clause] | None = None):
        self.strings, self.clauses = strings, clauses or []

    def met(self) -> list[Clause]:
        own = _clause(self.strings) if self.strings is not None else None
        return [*self.clauses, *([own] if own else [])]


def _in_class(items) -> set[str] | None:
    chars: set[str] = set()
    for kind, value in items:
        if kind is op.LITERAL:
            chars.add(chr(value).lower())
        elif kind is op.RANGE and value[1] - value[0] < MOST_STRINGS:
            chars.update(chr(c).lower() for c in range(value[0], value[1] + 1))
        else:
            return None
    return chars


def _branches(branches: list[_Part]) -> _Part:
    if all(b.strings is not None for b in branches):
        strings = set().union(*[b.strings for b in branches])
        if len(strings) <= MOST_STRINGS:
            return _Part(strings)
    options: Clause = []
    for branch in branches:
        met = branch.met()
        if not met:
            return _Part(None)
        # One clause of the branch is enough to stand for it: the one with the fewest options.
        options += min(met, key=lambda c: (len(c), -sum(map(len, c))))
    return _Part(None, [options])


def _sequence(nodes) -> _Part:
    run: set[str] | None = {""}
    clauses: list[Clause] = []

    def close() -> None:
        if run is not None and (own := _clause(run)):
            clauses.append(own)

    for node in nodes:
        part = _analysed(node)
        if part.strings is not None and run is not None and len(run) * len(part.strings) <= MOST_STRINGS:
            run = {a + b for a in run for b in part.strings}
            continue
        close()
        run = part.strings
        clauses += part.clauses
    if not clauses:
        return _Part(run)
    close()
    return _Part(None, clauses)


def _analysed(node) -> _Part:
    kind, value = node
    if kind is op.LITERAL:
        return _Part({chr(value).lower()})
    if kind is op.IN:
        chars = _in_class(value)
        return _Part(chars if chars and len(chars) <= MOST_STRINGS else None)
    if kind is op.SUBPATTERN:
        return _sequence(value[3])
    if kind is op.BRANCH:
        return _branches([_sequence(b) for b in value[1]])
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
        low, high, inner = value
        part = _sequence(inner)
        if (low, high) == (0, 1):
            return _Part(part.strings | {""} if part.strings is not None else None)
        if low == 0:
            return _Part(None)
        if part.strings is not None and low == high and len(part.strings) ** low <= MOST_STRINGS:
            return _sequence(list(inner) * low)
        return _Part(None, part.met())
    if kind is op.AT or kind in (op.ASSERT, op.ASSERT_NOT):
        return _Part({""})
    return _Part(None)


def query_of(pattern: str, most_options: int = 64) -> list[Clause]:
    """Clauses that every match of ``pattern`` meets; empty if none are mandatory: scan everything."""
    return [c for c in _sequence(parser.parse(pattern)).met() if len(c) <= most_options]


class TrigramIndex:
    """Postings of the trigrams that some query names, over one block of texts."""

    def __init__(self, texts: list[str], wanted: frozenset[str]):
        self.size = len(texts)
        folded = [t.lower() for t in texts]
        self.postings = {
            gram: np.fromiter((i for i, t in enumerate(folded) if gram in t), np.int64) for gram in wanted
        }

    def candidates(self, query: list[Clause]) -> np.ndarray:
        """Numbers of the texts that meet all clauses."""
        rows = np.arange(self.size)
        for clause in query:
            met = [np.zeros(0, np.int64)]
            for grams in clause:
                own = rows
                for postings in sorted((self.postings[g] for g in grams), key=len):
                    own = np.intersect1d(own, postings, assume_unique=True)
                met.append(own)
            rows = np.unique(np.concatenate(met))
        return rows
