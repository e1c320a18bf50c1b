"""Terms in texts by one automaton: which terms occur, how often, and where first.

A term is its words with any run of blanks and hyphens between them, and no ASCII letter or digit on either side. Texts
are expected normalised and in lower case.
"""

from __future__ import annotations

import re
import sys
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# The index travels with the job, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEFT, RIGHT = "(?<![a-zA-Z0-9])", "(?![a-zA-Z0-9])"
GAP = r"[ \t\n\x0b\f\r\-]+"
_BLANKS = "\t\n\x0b\f\r-"
_RUN = re.compile(" {2,}")
#: Texts of an Arrow batch that are Python strings at the same time.
TEXTS_AT_ONCE = 64
_WORD = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")

Hits = dict[str, tuple[int, int]]


def _even(text: str) -> str:
    """The text with every blank and hyphen as a plain blank; replacing one by one is far faster than a translation table."""
    for blank in _BLANKS:
        text = text.replace(blank, " ")
    return text


def _key(text: str) -> str:
    """The text with every run of blanks and hyphens as one blank."""
    return _RUN.sub(" ", _even(text))


def _is_plain(term: str) -> bool:
    """Whether a term stands in keyed texts as it is: no blank or hyphen but single blanks between words."""
    return bool(term) and _key(term) == term and term == term.strip(" ")


def _pattern(term: str) -> re.Pattern:
    return re.compile(LEFT + GAP.join(re.escape(w) for w in term.split(" ")) + RIGHT)


class Text:
    """A text with its keyed form, and the way back from places there."""

    def __init__(self, text: str) -> None:
        self.text, even = text, _even(text)
        self.keyed, self._after, self._lost = even, [], []
        if "  " in even:
            lost = 0
            for run in _RUN.finditer(even):
                self._after.append(run.start() - lost + 1)
                lost += run.end() - run.start() - 1
                self._lost.append(lost)
            self.keyed = _RUN.sub(" ", even)

    def place(self, at: int) -> int:
        """Place in the text of a place in its keyed form."""
        passed = bisect_right(self._after, at)
        return at + self._lost[passed - 1] if passed else at

    def bounded(self, start: int, end: int) -> bool:
        keyed = self.keyed
        return (start == 0 or keyed[start - 1] not in _WORD) and (end == len(keyed) or keyed[end] not in _WORD)

    def measure(self, term: str) -> tuple[int, int] | None:
        """Number and first place of one term."""
        if not _is_plain(term):
            found = [m.start() for m in _pattern(term).finditer(self.text)]
            return (len(found), found[0]) if found else None
        count, first, at = 0, -1, self.keyed.find(term)
        while at >= 0:
            end = at + len(term)
            if self.bounded(at, end):
                first = at if first < 0 else first
                count += 1
            else:
                end = at + 1
            at = self.keyed.find(term, end)
        return (count, self.place(first)) if count else None


class TermIndex:
    """An automaton over the keys of all terms; a term with hyphens or odd blanks is confirmed where its key occurs."""

    def __init__(self, terms: Iterable[str]) -> None:
        self.plain, self.odd, self.always = [], {}, []
        self.automaton = ahocorasick.Automaton()
        keys: dict[str, list[str]] = {}
        for term in dict.fromkeys(terms):
            key = _key(term).strip(" ")
            if not key:
                self.always.append(term)
            else:
                keys.setdefault(key, []).append(term)
        for key, named in keys.items():
            self.automaton.add_word(key, (len(key), key if key in named else None, tuple(t for t in named if t != key)))
        if keys:
            self.automaton.make_automaton()
        self.any = bool(keys)

    def hits(self, text: Text) -> Hits:
        """Number and first place of every term that occurs; occurrences of one term do not overlap."""
        found: dict[str, list[int]] = {}
        maybe = list(self.always)
        for last, (size, plain, odd) in self.automaton.iter(text.keyed) if self.any else ():
            start, end = last + 1 - size, last + 1
            maybe += odd
            if plain is None or not text.bounded(start, end):
                continue
            seen = found.get(plain)
            if seen is None:
                found[plain] = [1, start, end]
            elif start >= seen[2]:
                seen[0] += 1
                seen[2] = end
        hits = {term: (n, text.place(first)) for term, (n, first, _) in found.items()}
        for term in dict.fromkeys(maybe):
            measured = text.measure(term)
            if measured:
                hits[term] = measured
        return hits


_BUILT: dict[tuple[str, ...], TermIndex] = {}


def index_of(terms: tuple[str, ...]) -> TermIndex:
    """Built once for each task."""
    if terms not in _BUILT:
        _BUILT.clear()
        _BUILT[terms] = TermIndex(terms)
    return _BUILT[terms]


def in_slices(values: pa.Array) -> Iterator[list]:
    """The values of an Arrow batch as Python objects, few at a time: a batch holds up to thousands of whole texts."""
    for low in range(0, len(values), TEXTS_AT_ONCE):
        yield values.slice(low, TEXTS_AT_ONCE).to_pylist()


def scored_skills(texts: Column, entries: tuple[tuple[str, str], ...]) -> Column:
    """Array of (skill, score): the shown names of the entries (term, shown) that occur, then the extras.

    ``texts`` are structs of a normalised ``text`` and ``extras``, names found by other means: one argument, since the optimizer
    repeats what two would share. Every name is there once, and is itself counted and placed as a term: its
    score is its occurrences plus the earliness of the first, null if it has none, as its triggers may be other terms.
    One pass of an automaton finds and counts all entries.
    """
    terms = tuple(dict.fromkeys([t for t, _ in entries] + [shown.lower() for _, shown in entries]))

    kind = pa.list_(pa.struct([("skill", pa.string()), ("score", pa.float64())]))

    def of_text(index: TermIndex, known: frozenset[str], value: str | None, more: list[str] | None) -> list[dict] | None:
        if value is None:
            return None
        text = Text(value)
        hits = index.hits(text)
        names = dict.fromkeys(shown for term, shown in entries if term in hits)
        names.update(dict.fromkeys(more if more is not None else ()))
        rows = []
        for name in names:
            lowered = name.lower()
            seen = hits.get(lowered) if lowered in known else text.measure(lowered)
            rows.append({"skill": name, "score": seen and seen[0] + (1.0 - seen[1] / max(1, len(value)))})
        return rows

    @F.arrow_udf("array<struct<skill string, score double>>")
    def measured(batch: pa.Array) -> pa.Array:
        index, known, out = index_of(terms), frozenset(terms), [pa.array([], kind)]
        for rows in in_slices(batch):
            out.append(pa.array([None if r is None else of_text(index, known, r["text"], r["extras"]) for r in rows], kind))
        return pa.concat_arrays(out)

    return measured(texts)


def terms_found(normalized: Column, terms: tuple[str, ...]) -> Column:
    """Array of the numbers of the terms that occur, ascending."""
    @F.arrow_udf("array<int>")
    def numbers(texts: pa.Array) -> pa.Array:
        index, number, kind = index_of(terms), {}, pa.list_(pa.int32())
        for i, term in enumerate(terms):
            number.setdefault(term, []).append(i)
        out = [pa.array([], kind)]
        for some in in_slices(texts):
            out.append(pa.array([None if t is None else sorted(i for term in index.hits(Text(t)) for i in number[term]) for t in some], kind))
        return pa.concat_arrays(out)

    return numbers(normalized)
